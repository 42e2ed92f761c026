"""Native tool tables shaped from the parts, parsed as the library parses them.

Cells are text, as the tools write them; each is one expression that Spark and
the oracle both understand. The oracle states what must come out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.operators import collect, native

BIN = "concat('b', p_partkey)"
LINEAGE = "concat('d__Bacteria;p__', p_brand, CASE WHEN p_size % 2 = 0 THEN concat('; c__', p_size, ';o__') ELSE ';;g__x' END)"
CELLS: dict[str, dict[str, str]] = {
    "checkm1": {"Bin Id": "concat('b', p_partkey, '.fa')", "Completeness": "concat('', p_size * 3)", "Contamination": "concat(p_size % 40 * 10, '.5')", "Marker lineage": "CASE WHEN p_size % 11 = 0 THEN ' ' ELSE concat(' ', p_brand) END"},
    "checkm2": {"Name": BIN, "Completeness": "CASE WHEN p_size % 13 = 0 THEN 'NA' ELSE concat(p_size, '.25') END", "Contamination": "concat(p_size % 9, '')", "Completeness_Model_Used": "concat(p_brand, ' ')"},
    "gvclass": {"query": BIN, "estimated_completeness": "CASE WHEN p_size % 3 = 0 THEN '' ELSE concat(p_size, '.5') END", "estimated_contamination": "CASE WHEN p_size % 2 = 0 THEN 'NA' ELSE concat('', p_size % 8) END", "estimated_completeness_strategy": "concat('s', p_size % 4)", "estimated_contamination_strategy": "'t'", "taxonomy_majority": LINEAGE, "taxonomy_confidence": "concat('high ', p_size)", **{c: "concat('q', p_size % 5)" for c in native.SUPPORT}},
    "gtdbtk": {"user_genome": "concat('x/', 'b', p_partkey, '.fna')", "classification": f"CASE WHEN p_size % 5 = 0 THEN ' Unclassified Bacteria' ELSE {LINEAGE} END"},
    "busco": {"Input_file": "concat('b', p_partkey, '.FAA')", "Dataset": "CASE WHEN p_size % 10 = 0 THEN 'No genes found' ELSE concat(p_brand, '_odb') END", **{c: f"CASE WHEN p_size % 10 = 0 THEN '' ELSE concat('', p_size {op}) END" for c, op in (("Complete", "+ 1"), ("Duplicated", "% 7"), ("Fragmented", "% 5"), ("Missing", "% 3"), ("n_markers", "+ 200"))}},
    "symclatron": {"taxon_oid": BIN, "confidence": "concat('0.', p_size + 40)", "passes_confidence_threshold": "CASE WHEN p_size + 40 >= 73 THEN 'True' ELSE 'false' END", "completeness_UNI56": "concat('', p_size * 2)", "classification": "p_brand", "classification_thresholded": "concat(p_brand, '!')"},
    "quickclade": {"#QueryName": BIN, "lineage": LINEAGE, "Confidence": "CASE WHEN p_size % 4 = 0 THEN 'NA' ELSE 'domain:0.9;phylum:0.5;' END", "ConfLevel": "CASE WHEN p_size % 4 = 0 THEN 'p:0.25' ELSE '' END"},
    "ssu": {"name": "concat('n', p_partkey)", "coordinates": "concat(p_size, '-', p_size + 99)", "model": "CASE WHEN p_size % 2 = 0 THEN 'RF00177' ELSE 'RF01960' END", "strand": "CASE WHEN p_size % 3 = 0 THEN '+' ELSE '-' END", "blast_pident": "CASE WHEN p_size % 6 = 0 THEN '' ELSE concat(p_size + 40, '.5') END", "blast_query_coverage": "CASE WHEN p_size % 6 = 0 THEN '' ELSE '0.75' END", "blast_sseqid": "CASE WHEN p_size % 6 = 0 THEN 'NA' ELSE concat('h', p_partkey) END", "contig_name": "concat(' c', p_partkey)", "length": "CASE WHEN p_size % 17 = 0 THEN '99' ELSE '100' END", "reference_identifiers": "concat('i', p_size)", "reference_source": "'r'", "reference_versions": "''", "reference_taxonomy": "p_brand", "taxonomy": "p_type", "taxonomy_assignment_method": "'blast'"},
    "genomad": {"seq_name": "CASE WHEN p_size % 2 = 0 THEN concat('c', p_partkey, '|provirus_', p_size, '_', p_size + 9) ELSE concat('c', p_partkey) END", "length": "CASE WHEN p_size % 2 = 0 THEN '10' ELSE '1000' END", "topology": "CASE WHEN p_size % 2 = 0 THEN 'Provirus' ELSE 'Linear' END", "coordinates": "CASE WHEN p_size % 2 = 0 THEN concat(p_size, '-', p_size + 9) ELSE 'NA' END", "n_genes": "'4'", "genetic_code": "'11'", "virus_score": "concat('0.', p_size + 10)", "fdr": "'NA'", "n_hallmarks": "'1'", "marker_enrichment": "'1.5'", "taxonomy": "CASE WHEN p_size % 3 = 0 THEN 'Unclassified' ELSE concat('Viruses;R;', p_brand) END"},
    "contigs": {"contig_id": "concat('c', p_partkey)", "length_bp": "CAST(1000 AS BIGINT)"},
    "checkv": {"contig_id": "concat('v', p_partkey)", "contig_length": "'500'", "provirus": "CASE WHEN p_size % 2 = 0 THEN 'Yes' ELSE 'No' END", "proviral_length": "CASE WHEN p_size % 2 = 0 THEN '400' ELSE 'NA' END", "gene_count": "'9'", "viral_genes": "'5'", "host_genes": "concat('', p_size % 6)", "checkv_quality": "'Low'", "miuvig_quality": "'Genome-fragment'", "completeness": "CASE WHEN p_size % 3 = 0 THEN 'NA' ELSE concat(p_size, '.0') END", "completeness_method": "CASE WHEN p_size % 3 = 0 THEN 'NA' ELSE 'AAI' END", "contamination": "CASE WHEN p_size % 4 = 0 THEN '' ELSE concat('', p_size % 9) END", "kmer_freq": "'1.0'"},
    "eggnog": {"#query": "concat('g', p_partkey)", "Description": "CASE WHEN p_size % 4 = 0 THEN '-' ELSE p_type END", "evalue": "CASE WHEN p_size % 5 = 0 THEN '-' ELSE '0.25' END", "score": "concat(p_size, '.5')", "eggNOG_OGs": "concat('O', p_size, '@1|root,O', p_size, '@2|x')", "GOs": "concat('GO:000000', p_size % 10, ',GO:000000', p_size % 10)", "EC": "CASE WHEN p_size % 3 = 0 THEN '-' ELSE concat('1.1.1.', p_size, ',2.-.-.-') END", "KEGG_ko": "concat('ko:K0000', p_size % 10)"},
    "interpro": {"protein": "concat('g', p_partkey)", "analysis": "'Pfam'", "signature": "concat('PF', p_size)", "signature_name": "p_type", "start": "concat('', p_size)", "stop": "concat('', p_size + 9)", "score": "CASE WHEN p_size % 4 = 0 THEN '-' ELSE concat(p_size, '.5') END", "entry": "CASE WHEN p_size % 3 = 0 THEN '-' ELSE concat('IPR00000', p_size % 10) END", "entry_name": "p_brand"},
    "viruses": {"target": "concat('v', p_partkey)", "record_id": "concat('r', p_partkey)"},
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def shaped(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/part.parquet").selectExpr(*[f"{e} AS `{c}`" for c, e in CELLS[name].items()])


def _add(name: str, make: Callable[[Callable[[str], DataFrame]], DataFrame], sql: str) -> None:
    QUERIES[name] = lambda spark, sf_dir: make(lambda table: shaped(spark, sf_dir, table))
    ORACLE_SQL[name] = sql


def _scope(tool: str, collection: str = "qc") -> str:
    return f"'{tool}:{collection}:' || {BIN} AS record_id, 'bin' AS target_kind, {BIN} AS target_id"


def _ranked(where: str = "true") -> str:
    """(p_partkey, p_size, rank, taxon_name, place) of LINEAGE, for parts that ``where`` chooses."""
    return f"""SELECT p_partkey, p_size, 'domain' AS rank, 'Bacteria' AS taxon_name, 0 AS place FROM part WHERE {where} UNION ALL SELECT p_partkey, p_size, 'phylum', p_brand, 1 FROM part WHERE {where}
UNION ALL SELECT p_partkey, p_size, CASE WHEN p_size % 2 = 0 THEN 'class' ELSE 'genus' END, CASE WHEN p_size % 2 = 0 THEN CAST(p_size AS VARCHAR) ELSE 'x' END, 2 FROM part WHERE {where}"""


def _taxa(tool: str) -> str:
    return f"'{tool}:taxonomy:b' || p_partkey || ':' || rank AS record_id, 'bin' AS target_kind, {BIN} AS target_id, rank, taxon_name"


def _symclatron(cells: Callable[[str], DataFrame]) -> native.Parsed:
    table = cells("symclatron")
    brand = F.col("classification")
    ends = lambda k: table.where(brand.endswith(k)).select(F.col("taxon_oid").alias("target"))
    call = F.when(brand.contains("#2"), F.lit("d__Eukaryota;x")).otherwise("d__Archaea;x")
    calls = table.select(F.col("taxon_oid").alias("target"), call.alias("classification"), F.when(brand.contains("#3"), F.lit("Domain questionable")).otherwise("").alias("warnings"))
    return native.symclatron(table, ends("1"), ends("2"), calls)


_add("native_checkm1", lambda t: native.checkm1(t("checkm1")).rows["qc"], f"SELECT {_scope('checkm1')}, CAST(p_size * 3 AS DOUBLE) AS completeness_percent, p_size % 40 * 10 + 0.5::DOUBLE AS contamination_percent, CASE WHEN p_size % 11 = 0 THEN '' ELSE p_brand END AS completeness_basis, 'CheckM1 marker-set multi-copy estimate' AS contamination_basis FROM part")
_add("native_problems", lambda t: native.checkm1(t("checkm1")).problems, f"SELECT {BIN} AS target, 'completeness' AS detail FROM part WHERE p_size * 3 > 100 UNION ALL SELECT {BIN}, 'empty marker lineage' FROM part WHERE p_size % 11 = 0")
_add("native_checkm2", lambda t: native.checkm2(t("checkm2")).rows["qc"], f"SELECT {_scope('checkm2')}, CASE WHEN p_size % 13 <> 0 THEN p_size + 0.25::DOUBLE END AS completeness_percent, CAST(p_size % 9 AS DOUBLE) AS contamination_percent, p_brand AS completeness_basis, 'CheckM2 reported contamination' AS contamination_basis FROM part")
_add("native_gvclass", lambda t: native.gvclass(t("gvclass")).rows["qc"], f"SELECT {_scope('gvclass')}, CASE WHEN p_size % 3 <> 0 THEN p_size + 0.5::DOUBLE END AS completeness_percent, CASE WHEN p_size % 3 <> 0 THEN 's' || (p_size % 4) END AS completeness_basis, CASE WHEN p_size % 2 <> 0 THEN CAST(p_size % 8 AS DOUBLE) END AS contamination_percent, CASE WHEN p_size % 2 <> 0 THEN 't' END AS contamination_basis, {', '.join(f'{chr(39)}q{chr(39)} || (p_size % 5) AS {c}' for c in native.SUPPORT)} FROM part WHERE p_size % 3 <> 0 OR p_size % 2 <> 0")
_add("native_gvclass_taxonomy", lambda t: native.gvclass(t("gvclass")).rows["taxonomy"].select("record_id", "target_kind", "target_id", "rank", "taxon_name", "lineage_confidence"), f"SELECT {_taxa('gvclass')}, 'high ' || p_size AS lineage_confidence FROM ({_ranked()})")
_add("native_gtdbtk", lambda t: native.gtdbtk(t("gtdbtk")).rows["taxonomy"], f"SELECT {_taxa('gtdbtk')} FROM ({_ranked('p_size % 5 <> 0')}) UNION ALL SELECT 'gtdbtk:taxonomy:b' || p_partkey || ':domain', 'bin', {BIN}, 'domain', 'Unclassified Bacteria' FROM part WHERE p_size % 5 = 0")
_add("native_busco", lambda t: native.busco(t("busco")).rows["qc"], f"SELECT {_scope('busco')}, CAST(p_size + 1 AS DOUBLE) AS completeness_percent, 'BUSCO ' || p_brand || '_odb complete (n=' || (p_size + 200) || ')' AS completeness_basis, CAST(p_size % 7 AS DOUBLE) AS contamination_percent, 'BUSCO duplicated (not a contamination estimate)' AS contamination_basis FROM part WHERE p_size % 10 <> 0")
_add(
    "native_symclatron", lambda t: _symclatron(t).rows["phenotypes"],
    f"""SELECT *, applicability_reason IS NULL AS is_applicable FROM (SELECT 'symclatron:phenotype:' || {BIN} AS record_id, {BIN} AS bin_id, p_brand AS raw_class, CAST('0.' || (p_size + 40) AS DOUBLE) AS raw_score, 0.725::DOUBLE AS threshold, p_size + 40 >= 73 AS passes_threshold, p_brand || '!' AS thresholded_class,
 CASE WHEN p_brand LIKE '%1' THEN 'CheckEUK assigns eukaryotic taxonomy' WHEN p_brand LIKE '%2' THEN 'GVClass majority is viral' WHEN p_brand LIKE '%#3%' THEN 'GTDB-Tk flags the domain as questionable' WHEN p_brand LIKE '%#2%' THEN 'No GTDB-Tk bacterial or archaeal classification' WHEN p_size * 2 < 50 THEN 'UNI56 completeness below 50 percent' END AS applicability_reason FROM part)""",
)
_add("native_quickclade", lambda t: native.quickclade(t("quickclade")).rows["taxonomy"], f"SELECT {_taxa('quickclade')}, CASE WHEN p_size % 4 = 0 THEN CASE rank WHEN 'phylum' THEN 0.25::DOUBLE END ELSE CASE rank WHEN 'domain' THEN 0.9::DOUBLE WHEN 'phylum' THEN 0.5::DOUBLE END END AS score FROM ({_ranked()})")
_add("native_ssu", lambda t: native.ssu(t("ssu")).rows["ssu"], "SELECT 'ssuextract:ssu:c' || p_partkey || ':' || p_size || '-' || (p_size + 99) || ':' || CASE WHEN p_size % 2 = 0 THEN 'RF00177' ELSE 'RF01960' END AS record_id, 'c' || p_partkey AS contig_id, CASE WHEN p_size % 2 = 0 THEN 'rrna_16s' ELSE 'rrna_18s' END AS ssu_type, CAST(p_size AS BIGINT) AS start, CAST(p_size + 99 AS BIGINT) AS \"end\", CASE WHEN p_size % 3 = 0 THEN 'plus' ELSE 'minus' END AS strand, CASE WHEN p_size % 6 <> 0 THEN 'h' || p_partkey END AS hit_accession, 'i' || p_size AS reference_identifiers, 'r' AS reference_source, CAST(NULL AS VARCHAR) AS reference_versions, p_brand AS reference_taxonomy, p_type AS taxon_name, 'blast' AS taxonomy_assignment_method, CASE WHEN p_size % 6 <> 0 THEN p_size + 40.5::DOUBLE END AS identity_percent, CASE WHEN p_size % 6 <> 0 THEN 75::DOUBLE END AS query_coverage_percent FROM part")
_add("native_ssu_problems", lambda t: native.ssu(t("ssu")).problems, "SELECT 'n' || p_partkey AS target, 'length disagrees with coordinates' AS detail FROM part WHERE p_size % 17 = 0")
_add("native_genomad", lambda t: native.genomad(t("genomad"), t("contigs")).rows["viruses"], "SELECT CASE WHEN p_size % 2 = 0 THEN 'c' || p_partkey || '|provirus_' || p_size || '_' || (p_size + 9) ELSE 'c' || p_partkey END AS target, 'genomad:virus:c' || p_partkey || CASE WHEN p_size % 2 = 0 THEN ':' || p_size || '-' || (p_size + 9) ELSE '' END AS record_id, 'c' || p_partkey AS contig_id, CAST(CASE WHEN p_size % 2 = 0 THEN p_size ELSE 1 END AS BIGINT) AS start, CAST(CASE WHEN p_size % 2 = 0 THEN p_size + 9 ELSE 1000 END AS BIGINT) AS \"end\", 'unknown' AS strand, CAST('0.' || (p_size + 10) AS DOUBLE) AS score, CASE WHEN p_size % 3 = 0 THEN 'Unclassified' ELSE 'Viruses;R;' || p_brand END AS viral_taxon FROM part")
_add("native_checkv", lambda t: native.checkv(t("checkv"), t("viruses")).rows["qc"], "SELECT 'checkv:qc:r' || p_partkey AS record_id, 'virus' AS target_kind, 'r' || p_partkey AS target_id, CASE WHEN p_size % 3 <> 0 THEN p_size::DOUBLE END AS completeness_percent, CASE WHEN p_size % 3 <> 0 THEN 'AAI' END AS completeness_basis, CASE WHEN p_size % 4 <> 0 THEN (p_size % 9)::DOUBLE END AS contamination_percent, CASE WHEN p_size % 4 <> 0 THEN 'CheckV predicted host-region fraction' END AS contamination_basis FROM part WHERE p_size % 3 <> 0 OR p_size % 4 <> 0")

# ---------------------------------------------------------------- annotations

_add(
    "native_eggnog", lambda t: collect.annotation_rows(collect.eggnog(t("eggnog"), "5.0"))[0].select("annotation_id", "gene_id", "database_name", "database_version", "accession", "function_name", "score", "evalue"),
    """WITH x AS (SELECT DISTINCT 'g' || p_partkey AS gene_id, 'eggNOG' AS database_name, unnest(['O' || p_size || '@1', 'O' || p_size || '@2']) AS accession, CASE WHEN p_size % 4 <> 0 THEN p_type END AS function_name, p_size FROM part
UNION SELECT 'g' || p_partkey, 'Gene Ontology via eggNOG', 'GO:000000' || (p_size % 10), NULL, p_size FROM part UNION SELECT 'g' || p_partkey, 'Enzyme Commission via eggNOG', unnest(['1.1.1.' || p_size, '2.-.-.-']), NULL, p_size FROM part WHERE p_size % 3 <> 0 UNION SELECT 'g' || p_partkey, 'KEGG Orthology via eggNOG', 'ko:K0000' || (p_size % 10), NULL, p_size FROM part)
SELECT 'ann:eggnog:' || sha256(concat_ws(chr(31), 'eggnog', gene_id, database_name, accession, 'None', 'None')) AS annotation_id, gene_id, database_name, '5.0' AS database_version, accession, function_name, p_size + 0.5::DOUBLE AS score, CASE WHEN p_size % 5 <> 0 THEN 0.25::DOUBLE END AS evalue FROM x""",
)
_add(
    "native_interpro", lambda t: collect.annotation_rows(collect.interpro(t("interpro"), "9"))[0].select("annotation_id", "gene_id", "database_name", "database_version", "accession", "function_name", "start", "end", "score"),
    """WITH x AS (SELECT 'g' || p_partkey AS gene_id, 'InterProScan:Pfam' AS database_name, 'PF' || p_size AS accession, p_type AS function_name, CASE WHEN p_size % 4 <> 0 THEN p_size + 0.5::DOUBLE END AS score, p_size FROM part UNION ALL SELECT 'g' || p_partkey, 'InterPro', 'IPR00000' || (p_size % 10), p_brand, NULL, p_size FROM part WHERE p_size % 3 <> 0)
SELECT 'ann:interproscan:' || sha256(concat_ws(chr(31), 'interproscan', gene_id, database_name, accession, p_size, p_size + 9)) AS annotation_id, gene_id, database_name, '9' AS database_version, accession, function_name, CAST(p_size AS BIGINT) AS start, CAST(p_size + 9 AS BIGINT) AS "end", score FROM x""",
)
