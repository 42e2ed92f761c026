import pytest
from test_integrity import tables, valid

from tessella.sources import sinks, versions


def small(spark, n=1):
    rows = {k: r for k, r in valid().items() if k in ("samples", "runs")}
    rows["samples"] = rows["samples"] + [(f"s{k}", None, 11) for k in range(1, n)]
    return tables(spark, rows)


def count(spark, path):
    return versions.read(spark, path)["samples"].count()


def test_readers_see_one_whole_version(spark, tmp_path):
    path = f"{tmp_path}/catalog"
    assert versions.current(spark, path) is None
    with pytest.raises(FileNotFoundError):
        versions.read(spark, path)
    versions.publish(spark, small(spark), path)
    held = versions.read(spark, path)
    assert sorted(held) == ["runs", "samples"]
    versions.publish(spark, small(spark, 3), path)
    assert held["samples"].count() == 1 and count(spark, path) == 3  # who read before still reads the old one
    versions.publish(spark, small(spark, 4), path)
    assert count(spark, path) == 4 and len(list((tmp_path / "catalog/versions").iterdir())) == 2
    assert [n for n, _ in versions.pointers(spark, path)] == [3, 2]


def test_failures_of_every_step_leave_the_old_version(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/catalog"
    versions.publish(spark, small(spark), path)
    broken = small(spark) | {"samples": small(spark)["samples"].union(small(spark)["samples"])}
    with pytest.raises(ValueError, match="duplicate sample"):
        versions.publish(spark, broken, path)
    monkeypatch.setattr(versions, "require_valid", lambda tables: None)
    with pytest.raises(Exception, match="stop here"):
        versions.publish(spark, small(spark, 2) | {"zzz": spark.sql("select raise_error('stop here') as x")}, path)
    with pytest.raises(OSError, match="no pointer"):
        with monkeypatch.context() as m:
            m.setattr(versions, "_point", lambda *a: (_ for _ in ()).throw(OSError("no pointer")))
            versions.publish(spark, small(spark, 2), path)
    assert count(spark, path) == 1 and len(list((tmp_path / "catalog/versions").iterdir())) == 1
    (tmp_path / "catalog/_pointers/000000000002").write_text("deadbeef 12")  # a publisher died half way
    assert count(spark, path) == 1
    versions.publish(spark, small(spark, 2), path)
    assert count(spark, path) == 2 and [n for n, _ in versions.pointers(spark, path)] == [3, 1]


def test_of_two_publishers_one_fails(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/catalog"
    versions.publish(spark, small(spark), path)
    real = versions._point

    def late(spark, path, number, version):
        real(spark, path, number, version)  # the other one was faster
        real(spark, path, number, version)

    monkeypatch.setattr(versions, "_point", late)
    with pytest.raises(Exception, match="(?i)exist"):
        versions.publish(spark, small(spark, 2), path)


def test_swapped_folders_notice_a_failed_rename(spark, tmp_path, monkeypatch):
    path = tmp_path / "catalog"
    sinks.publish(spark, small(spark), str(path))
    path.parent.chmod(0o755)
    sinks.publish(spark, small(spark, 2), str(path))
    assert spark.read.parquet(f"{path}/samples").count() == 2
    assert [p.name for p in tmp_path.iterdir() if p.name != "catalog" and not p.name.endswith(".crc")] == []
