"""Files, folders and documents that the library writes and reads, made from the test tables, read back and queried."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessella.operators import binning, collect, cover, genes, native, schema_rules
from tessella.plans import catalog, report
from tessella.plans.domain import table
from tessella.sources import artifacts, documents, manifests, routed, samples, scratch, sinks, tables, versions

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str) -> Callable:
    def keep(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__], ORACLE_SQL[f.__name__] = f, sql
        return f

    return keep


# ---------------------------------------------------------------- rules of single fields

NAME = r"^[A-Za-z0-9][A-Za-z0-9_.-]*$"
FIELD_SCHEMA = {
    "properties": {n: {"type": "array", "items": {"$ref": f"#/$defs/{n}"}} for n in ("artifacts", "ssu", "runs")},
    "$defs": {
        "name": {"type": "string", "pattern": NAME},
        "artifacts": {"type": "object", "additionalProperties": False, "required": ["artifact_id", "producer_stage_id"], "properties": {
            "sample_id": {"$ref": "#/$defs/name"}, "run_id": {"$ref": "#/$defs/name"}, "artifact_id": {"type": "string", "pattern": "^p[0-9]{1,3}$"}, "kind": {"type": "string", "enum": ["protein_fasta", "gene_annotation"]}, "path": {"type": "string", "maxLength": 20},
            "size_bytes": {"type": "integer", "minimum": 5, "maximum": 45}, "producer_stage_id": {"type": "string", "pattern": "^st[1-4]"}}},
        "ssu": {"type": "object", "required": ["contig_id", "note"], "properties": {"start": {"type": "integer", "exclusiveMinimum": 50}, "strand": {"enum": ["+", "-"]}, "taxon_name": {"const": "A"}, "note": {"type": "string"}}},
        "runs": {"type": "object", "properties": {"platform": {"type": "string", "enum": ["ont", "pacbio"]}, "rna_technology": {"anyOf": [{"type": "string", "minLength": 6}, {"type": "null"}]}, "run_id": {"type": "integer"}}},
    },
}
FIELD_KEYS = {"artifacts": "artifact_id", "ssu": "record_id", "runs": "run_id"}
_SSU = catalog.ITEM


@query(f"""SELECT 'artifacts' AS "table", 'p' || p_partkey AS key, field, rule, value FROM (SELECT p_partkey, unnest([
 CASE WHEN p_partkey >= 1000 THEN {{'field': 'artifact_id', 'rule': 'pattern', 'value': 'p' || p_partkey}} END, CASE WHEN p_size >= 20 THEN {{'field': 'kind', 'rule': 'enum', 'value': 'report'}} END,
 CASE WHEN length('x/' || p_name) > 20 THEN {{'field': 'path', 'rule': 'maxLength', 'value': 'x/' || p_name}} END, CASE WHEN p_size < 5 THEN {{'field': 'size_bytes', 'rule': 'minimum', 'value': CAST(p_size AS VARCHAR)}} END,
 CASE WHEN p_size > 45 THEN {{'field': 'size_bytes', 'rule': 'maximum', 'value': CAST(p_size AS VARCHAR)}} END, CASE WHEN NOT regexp_matches('st' || p_size, '^st[1-4]') THEN {{'field': 'producer_stage_id', 'rule': 'pattern', 'value': 'st' || p_size}} END,
 {{'field': 'sha256', 'rule': 'unknown field', 'value': NULL}}], recursive := true) FROM part WHERE p_brand IS NOT NULL) WHERE field IS NOT NULL
UNION ALL SELECT 'ssu', {_SSU}, field, rule, value FROM (SELECT *, unnest([CASE WHEN l_partkey + 1 <= 50 THEN {{'field': 'start', 'rule': 'exclusiveMinimum', 'value': CAST(l_partkey + 1 AS VARCHAR)}} END,
 CASE WHEN l_returnflag <> 'A' THEN {{'field': 'taxon_name', 'rule': 'const', 'value': l_returnflag}} END, {{'field': 'note', 'rule': 'required', 'value': NULL}}], recursive := true) FROM lineitem) WHERE field IS NOT NULL
UNION ALL SELECT 'runs', 'r' || n_nationkey, field, rule, value FROM (SELECT *, unnest([CASE WHEN n_regionkey = 2 THEN {{'field': 'rna_technology', 'rule': 'minLength', 'value': 'short'}} END, {{'field': 'run_id', 'rule': 'type', 'value': 'r' || n_nationkey}}], recursive := true) FROM nation) WHERE field IS NOT NULL""")
def field_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broken rules of single fields in three catalog tables, by rules compiled from a schema."""
    t = catalog.tables(spark, sf_dir)
    return schema_rules.table_violations({n: t[n] for n in FIELD_KEYS}, FIELD_SCHEMA, FIELD_KEYS)


# ---------------------------------------------------------------- catalogs and bundles


@query("SELECT 's' || c_custkey AS sample_id, 'r' || c_nationkey AS run_id, 'HIFI' AS platform, CAST(c_custkey % 20 + 1 AS INTEGER) AS genetic_code FROM customer")
def published_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions of a catalog published one after the other; what readers find is the second."""
    rows = table(spark, sf_dir, "customer").select(F.concat(F.lit("s"), "c_custkey").alias("sample_id"), "c_custkey", "c_nationkey")
    whole = {
        "samples": rows.select("sample_id", F.lit(None).cast("string").alias("description"), (F.col("c_custkey") % 20 + 1).cast("int").alias("genetic_code")),
        "runs": rows.select("sample_id", F.concat(F.lit("r"), "c_nationkey").alias("run_id"), F.lit("HIFI").alias("platform"), *[F.lit(None).cast("string").alias(c) for c in ("rna_technology", "basecaller", "basecaller_model", "library_prep")]),
    }
    path = scratch.folder(spark)
    first = rows.where("c_custkey % 2 = 0").select("sample_id")
    versions.publish(spark, {n: d.join(first, "sample_id", "left_semi") for n, d in whole.items()}, path)
    versions.publish(spark, whole, path)
    t = versions.read(spark, path)
    return t["runs"].select("sample_id", "run_id", "platform").join(t["samples"].select("sample_id", "genetic_code"), "sample_id")


BUNDLE = T.StructType([
    T.StructField("schema_version", T.StringType()), T.StructField("bins", T.ArrayType(T.StructType([T.StructField("bin_id", T.StringType()), T.StructField("size", T.LongType()), T.StructField("marks", T.ArrayType(T.StringType()))]))),
    T.StructField("genes", T.ArrayType(T.StructType([T.StructField("gene_id", T.StringType()), T.StructField("score", T.DoubleType())]))),
])


@query("""SELECT 'bins' AS collection, 'b' || o_orderkey AS id, CAST(CASE WHEN o_custkey % 3 > 0 THEN o_custkey END AS DOUBLE) AS value, o_orderpriority || '|' || o_orderstatus AS marks FROM orders
UNION ALL SELECT 'genes', 'g"' || p_partkey, CAST(p_size AS DOUBLE) / 8, NULL FROM part""")
def bundle_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two collections written as one metadata bundle and read back by its schema."""
    bins = table(spark, sf_dir, "orders").select(F.concat(F.lit("b"), "o_orderkey").alias("bin_id"), F.when(F.col("o_custkey") % 3 > 0, F.col("o_custkey")).cast("long").alias("size"), F.array("o_orderpriority", "o_orderstatus").alias("marks"))
    found = table(spark, sf_dir, "part").select(F.concat(F.lit('g"'), "p_partkey").alias("gene_id"), (F.col("p_size").cast("double") / 8).alias("score"))
    path = f"{scratch.folder(spark)}.json"
    manifests.write_bundle({"bins": bins, "genes": found}, {"schema_version": "1"}, {"bins": ["bin_id"], "genes": ["gene_id"]}, path)
    back = tables.bundle_tables(spark, path, BUNDLE)
    left = back["bins"].select(F.lit("bins").alias("collection"), F.col("bin_id").alias("id"), F.col("size").cast("double").alias("value"), F.array_join("marks", "|").alias("marks"))
    return left.union(back["genes"].select(F.lit("genes"), "gene_id", "score", F.lit(None).cast("string")))


@query("""WITH i AS (SELECT o_custkey, 'a' || o_orderkey AS k, row_number() OVER (PARTITION BY o_custkey ORDER BY 'a' || o_orderkey) - 1 AS p FROM orders)
SELECT 's' || o_custkey AS stage_id, CAST(p AS INTEGER) AS position, 'input' AS collection, k AS record_id FROM i UNION ALL SELECT 's' || o_custkey, NULL, o_orderpriority, o_orderkey || ':x' FROM orders""")
def stage_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list columns of stages as tables: inputs with their position, expected keys split at the first colon."""
    key = F.concat("o_orderpriority", F.lit(":"), "o_orderkey", F.lit(":x"))
    stages = table(spark, sf_dir, "orders").groupBy(F.concat(F.lit("s"), "o_custkey").alias("stage_id")).agg(F.sort_array(F.collect_list(F.concat(F.lit("a"), "o_orderkey"))).alias("input_artifact_ids"), F.collect_list(key).alias("expected_result_keys"))
    inputs, expected = tables.stage_lists(stages.select(F.lit("s").alias("sample_id"), F.lit("r").alias("run_id"), "*"))
    return inputs.select("stage_id", "position", F.lit("input").alias("collection"), F.col("artifact_id").alias("record_id")).union(expected.select("stage_id", F.lit(None).cast("int"), "collection", "record_id"))


#: Folders that the manifests' files are dealt to; a task makes a folder's files, another one lists them.
FOLDERS = 256


@query("""SELECT 'g' || s_suppkey AS parent, tool AS stage, CASE WHEN s_suppkey % 3 = 0 THEN 'skipped' WHEN tool = 'beta' THEN 'pending' ELSE 'completed' END AS status, CASE WHEN s_suppkey % 3 = 0 THEN 'not asked' WHEN tool = 'beta' THEN 'beta had no applicable input in g' || s_suppkey || '.' END AS reason, tool || '.tsv' AS result, s_name AS log
 FROM supplier, (VALUES ('alpha'), ('beta')) v(tool)""")
def stage_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifests of grouped stages, one file each, read strictly and divided into their tools."""
    text = lambda c: F.to_json(c)
    done = F.col("s_suppkey") % 3 != 0
    tool = lambda n, status: F.struct(F.lit("1").alias("version"), F.lit(f"{n}.tsv").alias("output"), F.lit(status).alias("status"))
    document = F.struct(F.concat(F.lit("g"), "s_suppkey").alias("stage"), F.when(done, F.lit("completed")).otherwise(F.lit("skipped")).alias("status"), F.lit("t").alias("tool"), F.lit("1").alias("tool_version"), F.lit("run it").alias("command"), F.when(~done, F.lit("not asked")).alias("reason"),
                        F.struct(F.col("s_name").alias("log"), F.lit("all").alias("result")).alias("outputs"), F.struct(tool("alpha", None).alias("alpha"), tool("beta", "pending").alias("beta")).alias("tools"))
    path = scratch.folder(spark)
    placed = table(spark, sf_dir, "supplier").select(F.pmod("s_suppkey", F.lit(FOLDERS)).alias("folder"), text(document).alias("value"))
    # by number, as tables of few bytes would otherwise become one task, which makes all files
    placed.repartition(FOLDERS, "folder").write.partitionBy("folder").option("maxRecordsPerFile", 1).text(path)
    rows, bad = manifests.manifests(spark, path)
    if found := bad.first():
        raise ValueError(found.detail)
    return manifests.stages(rows).select("parent", "stage", "status", "reason", F.col("outputs")["result"].alias("result"), F.col("outputs")["log"].alias("log"))


@query("""WITH o AS (SELECT o_custkey, string_agg('{"key":' || o_orderkey || ',"status":"' || o_orderstatus || '"}', ',' ORDER BY lpad(CAST(o_orderkey AS VARCHAR), 12, '0')) AS orders FROM orders GROUP BY o_custkey),
 d AS (SELECT c_custkey, '{"customer":{"name":"' || c_name || '","nation":' || c_nationkey || '},"id":' || c_custkey || ',"orders":[' || coalesce(orders, '') || '],"status":{"segment":"' || c_mktsegment || '"}}' AS t FROM customer LEFT JOIN o ON o_custkey = c_custkey)
SELECT c_custkey AS id, sha256(t) AS sha256, CAST(strlen(t) AS BIGINT) AS size_bytes FROM d""")
def nested_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A nested document for each customer with all orders, streamed; digest and size of its canonical text."""
    c = table(spark, sf_dir, "customer").withColumn("id", F.col("c_custkey"))
    o = table(spark, sf_dir, "orders").join(c.select("id"), F.col("o_custkey") == F.col("id")).select("id", F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("place"), F.struct(F.col("o_orderstatus").alias("status"), F.col("o_orderkey").alias("key")).alias("r"))
    pieces = [
        documents.value(c, ["id"], ["id"], F.col("id")), documents.value(c, ["id"], ["customer"], F.struct(F.col("c_nationkey").alias("nation"), F.col("c_name").alias("name"))), documents.value(c, ["id"], ["status", "segment"], F.col("c_mktsegment")),
        documents.empty_lists(c, ["id"], ["orders"]), documents.items(o, ["id"], ["orders"], ["place"], F.col("r")),
    ]
    return documents.index(documents.streamed(pieces, ["id"]), ["id"]).select("id", "sha256", "size_bytes")


# ---------------------------------------------------------------- files


@query("""SELECT CAST(p_size AS VARCHAR) AS file, sha256(t) AS sha256, CAST(strlen(t) AS BIGINT) AS size_bytes FROM (SELECT p_size, string_agg(p_partkey || ' ' || p_name, chr(10) ORDER BY p_partkey) || chr(10) AS t FROM part GROUP BY p_size)""")
def file_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size and digest of files, streamed."""
    path = scratch.folder(spark)
    rows = table(spark, sf_dir, "part").select("p_size", "p_partkey", F.concat_ws(" ", "p_partkey", "p_name").alias("value"))
    rows.repartition("p_size").sortWithinPartitions("p_size", "p_partkey").select("p_size", "value").write.partitionBy("p_size").text(path)
    return artifacts.digests(spark, path).where(~F.col("path").endswith("_SUCCESS")).select(F.regexp_extract("path", "p_size=([0-9]+)", 1).alias("file"), "sha256", "size_bytes")


_ROUTE = "CASE p_size % 3 WHEN 0 THEN 'viral' WHEN 1 THEN 'eukaryotic' ELSE 'unresolved' END"


@query(f"""WITH s AS (SELECT {_ROUTE} AS route, 'b ' || p_size AS bin_id, 'c' || p_partkey AS name, CAST(4 * (p_partkey % 40 + 1) AS BIGINT) AS length_bp FROM part), t AS (SELECT route, bin_id, count(*) AS sequences, CAST(sum(length_bp) AS BIGINT) AS total_bp FROM s GROUP BY ALL)
SELECT route, bin_id, name, length_bp, sequences, total_bp FROM s JOIN t USING (route, bin_id)""")
def routed_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences staged in a folder for each bin, read back with the sources beside them."""
    rows = table(spark, sf_dir, "part").selectExpr(f"{_ROUTE} AS route", "concat('b ', p_size) AS bin_id", "p_partkey AS ordinal", "concat('c', p_partkey) AS name", "repeat('ACGT', cast(p_partkey % 40 + 1 as int)) AS sequence", "'p' AS parent_contig", "cast(1 as bigint) AS start", "cast(4 * (p_partkey % 40 + 1) as bigint) AS end")
    path = scratch.folder(spark)
    routed.write(rows, path)
    back, sources = routed.read(spark, path), routed.sources(spark, path)
    if found := routed.problems(back, sources, routed.origins(spark, path)).first():
        raise ValueError(found.detail)
    return back.select("route", "bin_id", "name", F.length("sequence").cast("long").alias("length_bp")).join(sources.withColumnRenamed("length_bp", "total_bp"), ["route", "bin_id"])


def _lines(spark: SparkSession, rows: DataFrame) -> str:
    path = scratch.folder(spark)
    rows.select("value").write.text(path)
    return path


def _prodigal_files(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    part = table(spark, sf_dir, "part").selectExpr("*", "p_partkey % 100 AS c", "concat_ws('_', p_partkey % 100, p_partkey) AS gene", "p_size % 2 = 0 AS forward")
    features = part.select(F.expr("concat_ws('\t', concat('c', c), 'caller', 'CDS', p_size + 1, p_size + 30, '.', if(forward, '+', '-'), '0', concat('ID=', gene, ';genetic_code=11'))").alias("value"))
    proteins = part.select(F.expr("concat('>c', c, '_', p_partkey, ' # ', p_size + 1, ' # ', p_size + 30, ' # ', if(forward, '1', '-1'), ' # ID=', gene, ';genetic_code=11\nMK', repeat('V', cast(p_size as int)), '*')").alias("value"))
    return tables.gff(spark, _lines(spark, features)), tables.fasta(spark, _lines(spark, proteins))


@query("""SELECT 'prodigal-gv:src:c' || p_partkey % 100 || '_' || p_partkey AS gene_id, 'c' || p_partkey % 100 AS contig_id, CAST(p_size + 1 AS BIGINT) AS start, CAST(p_size + 30 AS BIGINT) AS "end", CASE WHEN p_size % 2 = 0 THEN 'plus' ELSE 'minus' END AS strand, 0 AS phase, 11 AS genetic_code FROM part""")
def prodigal_genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Genes from a feature file and its proteins, which must agree."""
    found = genes.prodigal(*_prodigal_files(spark, sf_dir), "src", None, 11)
    if bad := found.problems.first():
        raise ValueError(f"{bad.target}: {bad.detail}")
    return found.rows["genes"].drop("bin_id")


@query("""SELECT 'prodigal-gv:src:c' || p_partkey % 100 || '_' || p_partkey AS normalized_id, 'c' || p_partkey % 100 || '_' || p_partkey AS native_id, p_partkey % 100 || '_' || p_partkey AS native_gene_id, 'MK' || repeat('V', CAST(p_size AS INTEGER)) AS sequence FROM part""")
def merged_proteins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proteins under normalized names without their final stop, with the mapping back."""
    found = genes.merged_proteins([(_prodigal_files(spark, sf_dir)[1], "prodigal-gv", "src", None)])
    if bad := found.problems.first():
        raise ValueError(f"{bad.target}: {bad.detail}")
    return found.rows["mapping"].select("normalized_id", "native_id", "native_gene_id").join(found.rows["proteins"].withColumnRenamed("name", "normalized_id"), "normalized_id")


@query("""SELECT 'braker3:s1:b1:g' || p_partkey || '.t1' AS gene_id, 'c' || p_size AS contig_id, CAST(p_partkey + 1 AS BIGINT) AS start, CAST(p_partkey + 90 AS BIGINT) AS "end", CASE WHEN p_partkey % 2 = 0 THEN 'plus' ELSE 'minus' END AS strand, CAST(CASE WHEN p_partkey % 2 = 0 THEN p_partkey % 3 ELSE p_size % 3 END AS INTEGER) AS phase, 1 AS genetic_code FROM part""")
def braker_genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Genes from transcripts with two coding parts; the phase is that of the first in reading direction."""
    part = table(spark, sf_dir, "part").selectExpr("*", "concat('g', p_partkey) AS g", "if(p_partkey % 2 = 0, '+', '-') AS s")
    row = lambda kind, a, b, phase, notes: f"concat_ws('\t', concat('c', p_size), 'A', '{kind}', p_partkey + {a}, p_partkey + {b}, '.', s, {phase}, {notes})"
    lines = [row("gene", 1, 90, "'.'", "concat('ID=', g)"), row("mRNA", 1, 90, "'.'", "concat('ID=', g, '.t1;Parent=', g)"), row("CDS", 1, 30, "p_partkey % 3", "concat('Parent=', g, '.t1')"), row("CDS", 60, 90, "p_size % 3", "concat('Parent=', g, '.t1')")]
    features = part.select(F.explode(F.array(*map(F.expr, lines))).alias("value"))
    proteins = part.select(F.expr("concat('>', g, '.t1\nMKV')").alias("value"))
    found = genes.braker(tables.gff(spark, _lines(spark, features)), tables.fasta(spark, _lines(spark, proteins)), "s1", "b1", 1)
    if bad := found.problems.first():
        raise ValueError(f"{bad.target}: {bad.detail}")
    return found.rows["genes"].drop("bin_id")


_CHECKEUK = {
    "genome": "concat('b', p_partkey, '.fa')", "status": "CASE WHEN p_size % 5 = 0 THEN 'filtered' ELSE 'ok' END", "completeness": "concat(p_size, '.5')", "completeness_basis": "p_brand", "contamination": "CASE WHEN p_size % 4 = 0 THEN 'NA' ELSE concat('', p_size % 9) END",
    "completeness_bom": "concat(p_size, '')", "pfam_completeness": "'12.25'", "pfam_observed_families": "concat(p_size, '')", "pfam_union_families": "'1085'", "lineage": "concat('d__Eukaryota;p__', p_type)", "completeness_note": "CASE WHEN p_size % 5 = 0 THEN 'too short' ELSE concat('markers ', p_size, '/', p_size + 20) END",
}
_DETAIL = {"genome": "concat('b', p_partkey)", "n_present_core": "concat(p_size, '')", "n_present_expected": "concat(p_size, '')", "n_expected": "concat(p_size + 20, '')"}


@query("""SELECT 'b' || p_partkey AS target_id, p_size + 0.5::DOUBLE AS completeness_percent, p_brand AS completeness_basis, CASE WHEN p_size % 4 > 0 THEN CAST(p_size % 9 AS DOUBLE) END AS contamination_percent, CAST(p_size AS BIGINT) AS checkeuk_expected_markers_present, CAST(p_size + 20 AS BIGINT) AS checkeuk_expected_markers_total, 12.25::DOUBLE AS checkeuk_pfam_ridge_completeness_percent FROM part WHERE p_size % 5 > 0""")
def native_checkeuk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurements of a report and its detail, both written as tables and read by their headers."""
    part = table(spark, sf_dir, "part")
    frames = []
    for cells in (_CHECKEUK, _DETAIL):
        path = scratch.folder(spark)
        sinks.write_table(part.selectExpr(*[f"{e} AS `{c}`" for c, e in cells.items()]), path, list(cells))
        frames.append(tables.read_table(spark, path, list(cells)))
    found = native.checkeuk(*frames)
    if bad := found.problems.where("detail <> 'marker counts'").first():
        raise ValueError(f"{bad.target}: {bad.detail}")
    return found.rows["qc"].select("target_id", "completeness_percent", "completeness_basis", "contamination_percent", "checkeuk_expected_markers_present", "checkeuk_expected_markers_total", "checkeuk_pfam_ridge_completeness_percent")


# ---------------------------------------------------------------- bins, links and sheets


@query("""SELECT 'c' || p_partkey AS contig_id, CAST(p_size AS DOUBLE) / 8 AS mean_depth_x, 'b' || p_size AS bin_id, 'b' || p_size || ':c' || p_partkey AS membership_id, 'lineage' AS rank, 'd__' || p_size % 7 AS taxon_name, CAST(p_size AS VARCHAR) AS taxon_id FROM part""")
def binned_contigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contigs with depth, membership and the lineage of their bin, from native rows that must cover each other."""
    part = table(spark, sf_dir, "part")
    contigs = part.select(F.concat(F.lit("c"), "p_partkey").alias("contig_id"))
    depths = part.selectExpr("concat('c', p_partkey) AS `#rname`", "cast(p_size / 8 as string) AS meandepth")
    records = part.selectExpr("concat('bins/b', p_size, '.fa') AS path", "concat('c', p_partkey) AS name")
    clades = part.select("p_size").distinct().selectExpr("concat('bins/b', p_size, '.fa') AS `#QueryName`", "concat('d__', p_size % 7) AS lineage", "cast(p_size as string) AS R_TaxID")
    found = binning.binned(contigs, depths, records, clades)
    if bad := found.problems.first():
        raise ValueError(f"{bad.target}: {bad.detail}")
    named = found.rows["taxonomy"].select(F.col("target_id").alias("bin_id"), "rank", "taxon_name", "taxon_id")
    return found.rows["contigs"].join(found.rows["memberships"], "contig_id").join(named, "bin_id")


@query("""WITH x AS (SELECT l_orderkey * 10 + l_linenumber AS ordinal, 'c' || l_partkey AS contig, l_suppkey % 2 = 0 AS euk_model, l_returnflag = 'A' OR l_linestatus = 'F' AS euk, l_linenumber % 2 = 0 AS pro FROM lineitem), p AS (SELECT 'c' || p_partkey AS contig, 'b' || p_size AS bin_id FROM part)
SELECT 'locus' AS kind, bin_id, ordinal, 'l' || ordinal || '@' || contig AS item FROM x JOIN p USING (contig) WHERE euk_model AND euk UNION ALL SELECT 'virus', bin_id, ordinal, CASE WHEN pro THEN contig || '|provirus_1_9' ELSE contig END FROM x JOIN p USING (contig)""")
def linked_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eukaryotic loci and viral calls, linked to bins by their contigs."""
    li = table(spark, sf_dir, "lineitem").selectExpr("*", "l_orderkey * 10 + l_linenumber AS ordinal", "concat('c', l_partkey) AS contig_name")
    loci = li.selectExpr("ordinal", "concat('l', ordinal) AS name", "contig_name", "if(l_suppkey % 2 = 0, 'RF01960', 'RF00177') AS model", "'t' AS taxonomy", "if(l_returnflag = 'A', 'Eukaryota', 'Unclassified') AS taxonomy_domain", "if(l_linestatus = 'F', 'Eukaryota;x', '') AS reference_taxonomy", "'' AS blast_candidate_taxonomy")
    viruses = li.selectExpr("ordinal", "if(l_linenumber % 2 = 0, concat(contig_name, '|provirus_1_9'), contig_name) AS seq_name", "'0.9' AS virus_score", "'Viruses' AS taxonomy")
    contigs = table(spark, sf_dir, "part").selectExpr("concat('c', p_partkey) AS contig_id", "concat('b', p_size) AS bin_id")
    both = [f(d, contigs).select(F.lit(k).alias("kind"), "bin_id", "ordinal", "item") for k, f, d in (("locus", binning.linked_loci, loci), ("virus", binning.linked_viruses, viruses))]
    return both[0].union(both[1])


@query("""WITH s AS (SELECT c_custkey, CASE WHEN c_custkey % 50 = 0 THEN 's' || c_nationkey || '-twice' ELSE 's' || c_custkey END AS sample_id FROM customer)
SELECT sample_id, d AS detail FROM (SELECT sample_id, unnest([CASE WHEN c_custkey % 7 = 0 THEN 'platform: enum' END, CASE WHEN c_custkey % 11 IN (7, 8) THEN 'genetic_code: pattern' END, CASE WHEN c_custkey % 13 = 0 THEN 'unsafe path' END, CASE WHEN c_custkey % 5 = 0 THEN 'RNA reads and platform belong together' END,
 CASE WHEN c_custkey % 3 = 0 THEN 'a masked assembly needs its assembly' END, CASE WHEN c_custkey % 2 = 1 OR c_custkey % 7 = 0 THEN 'basecaller of another platform' END]) AS d FROM s) WHERE d IS NOT NULL
UNION ALL SELECT sample_id, 'repeated sample' FROM s GROUP BY sample_id HAVING count(*) > 1""")
def sample_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is wrong with a sheet of samples, written and read by its header."""
    rows = table(spark, sf_dir, "customer").selectExpr(
        "if(c_custkey % 50 = 0, concat('s', c_nationkey, '-twice'), concat('s', c_custkey)) AS sample_id", "if(c_custkey % 7 = 0, 'Illumina', if(c_custkey % 2 = 0, 'ONT', 'PACBIO_HIFI')) AS platform", "if(c_custkey % 13 = 0, 'r$.fq', 'r.fq') AS reads",
        "if(c_custkey % 5 = 0, 'rna.fq', '') AS rna_reads", "cast(if(c_custkey % 11 = 0, '', cast(c_custkey % 11 as string)) as string) AS genetic_code", "if(c_custkey % 3 = 0, 'm.fa', '') AS softmasked", "'dorado' AS basecaller",
    )
    path = scratch.folder(spark)
    sinks.write_table(rows, path, rows.columns)
    return samples.problems(samples.read(spark, path))


@query("""WITH x AS (SELECT 'g' || p_partkey % 1500 AS gene_id, p_partkey, p_size FROM part)
SELECT DISTINCT gene_id, 'unknown protein' AS detail FROM x WHERE p_partkey % 1500 % 7 = 0 UNION ALL SELECT gene_id, 'repeated query' FROM x GROUP BY gene_id HAVING count(*) > 1 UNION ALL SELECT gene_id, 'score' FROM x WHERE p_size % 10 = 3
UNION ALL SELECT gene_id, 'negative evalue' FROM x WHERE p_size % 10 = 4 UNION ALL SELECT gene_id, 'invalid GOs' FROM x WHERE p_size % 10 = 5 UNION ALL SELECT gene_id, 'invalid EC' FROM x WHERE p_size % 10 = 6""")
def annotation_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Genes for which an orthology table, written with its header and read by it, must be refused."""
    part = table(spark, sf_dir, "part")
    cells = {
        "#query": "concat('g', p_partkey % 1500)", "evalue": "if(p_size % 10 = 4, '-0.5', '1e-9')", "score": "if(p_size % 10 = 3, 'high', '50')", "eggNOG_OGs": "concat('O', p_size, '@1|root')", "GOs": "if(p_size % 10 = 5, 'GO:1', '-')",
        "EC": "if(p_size % 10 = 6, '1.2', '1.2.3.-')", "KEGG_ko": "'ko:K00001,ko:K00002'",
    }
    rows = part.selectExpr(*[f"{cells.get(c, repr('-'))} AS `{c}`" for c in tables.EGGNOG])
    path = scratch.folder(spark)
    # the tool writes one header, so its lines go ahead of the rows' files
    head = spark.createDataFrame([("## made by a tool",), ("\t".join(tables.EGGNOG),)], "value string")
    head.coalesce(1).write.text(path)
    rows.select(F.concat_ws("\t", *[F.col(f"`{c}`") for c in tables.EGGNOG]).alias("value")).write.mode("append").text(path)
    proteins = part.where("p_partkey % 1500 % 7 <> 0").select(F.concat(F.lit("g"), F.col("p_partkey") % 1500).alias("name")).distinct()
    return collect.eggnog_problems(tables.eggnog(spark, path), proteins)


@query("""WITH x AS (SELECT 'c' || c_custkey AS sample_id, 'r1' AS run_id, 'x' || c_nationkey AS rev FROM customer)
SELECT sample_id, run_id, 'source revision differs' AS detail FROM x WHERE rev <> 'x3' UNION ALL SELECT sample_id, run_id, 'run is not in the catalog' FROM x WHERE sample_id NOT IN (SELECT 'c' || o_custkey FROM orders)""")
def execution_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Executions that are not those of a catalog of one revision, whose runs are the customers with orders."""
    t = {"catalog_metadata": table(spark, sf_dir, "region").where("r_regionkey = 3").selectExpr("concat('x', r_regionkey) AS source_revision"), "runs": table(spark, sf_dir, "orders").selectExpr("concat('c', o_custkey) AS sample_id", "'r1' AS run_id").distinct()}
    executions = table(spark, sf_dir, "customer").selectExpr("concat('c', c_custkey) AS sample_id", "'r1' AS run_id", "concat('x', c_nationkey) AS original_source_revision")
    return report.identity_problems(t, executions)


@query("""SELECT 'b' || p_partkey AS target, CASE WHEN p_size % 7 = 0 THEN 'empty bin' WHEN p_size % 7 = 1 THEN 'no protein file' WHEN p_size % 7 IN (2, 3) THEN 'warnings and empty proteins differ' END AS detail FROM part WHERE p_size % 7 IN (0, 1, 2, 3)
UNION ALL SELECT 'run', 'hits are there' WHERE EXISTS (SELECT 1 FROM part WHERE p_size = 1)""")
def no_annotation_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why a run without annotations is not accepted: bins, their proteins and the log do not tell one story."""
    part = table(spark, sf_dir, "part").selectExpr("concat('b', p_partkey) AS bin_id", "p_size % 7 AS k", "p_size")
    warned = part.where("k in (2, 4, 5)").select(F.concat(F.lit("[1] WARNING: Skipping protein file p/"), "bin_id", F.lit(".faa as it was empty.")).alias("value"))
    lines = warned.union(spark.createDataFrame([("[2] ERROR: No DIAMOND annotation was generated. Exiting",)], "value string"))
    bins = part.select("bin_id", F.when(F.col("k") == 0, 0).otherwise(5).alias("size_bytes"))
    proteins = part.where("k <> 1").select("bin_id", F.when(F.col("k").isin(3, 4, 5), 0).otherwise(9).alias("size_bytes"))
    hits = part.select(F.col("bin_id").alias("path"), F.when(F.col("p_size") == 1, 3).otherwise(0).alias("size_bytes"))
    return cover.no_annotation_problems(lines, hits, bins, proteins, 1, False)
