import random

import pytest
from pyspark.sql import functions as F

from tallyspark.operators import mutate as M
from tallyspark.session import scratch
from tallyspark.sources import files, incremental


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def target(spark):
    return spark.createDataFrame([(1, "a", 10), (2, "b", 20), (None, "n", 0)], "k INT, v STRING, extra INT")


def test_merge_upsert(spark):
    source = spark.createDataFrame([(2, "B"), (3, "C"), (None, "N"), (None, "N")], "k INT, v STRING")
    once = M.merge_upsert(target(spark), source, ["k"])
    assert rows(once) == [(1, "a", 10), (2, "B", 20), (3, "C", None), (None, "N", None), (None, "N", None), (None, "n", 0)]
    known = source.where("k IS NOT NULL")
    assert rows(M.merge_upsert(M.merge_upsert(target(spark), known, ["k"]), known, ["k"])) == rows(M.merge_upsert(target(spark), known, ["k"]))


def test_merge_rejects_two_rows_for_one_match(spark):
    twice = spark.createDataFrame([(2, "x"), (2, "y")], "k INT, v STRING")
    with pytest.raises(Exception, match="several source rows"):
        M.merge_upsert(target(spark), twice, ["k"]).collect()
    with pytest.raises(Exception, match="several source rows"):
        M.merge_update(target(spark), twice, ["k"], {"v": "v"}).collect()
    unmatched = spark.createDataFrame([(9, "x"), (9, "y")], "k INT, v STRING")
    assert M.merge_upsert(target(spark), unmatched, ["k"]).count() == 5
    assert rows(M.merge_update(target(spark), unmatched, ["k"], {"v": "v"})) == rows(target(spark))


def test_merge_update_writes_source_nulls(spark):
    source = spark.createDataFrame([(1, None)], "k INT, w STRING")
    assert rows(M.merge_update(target(spark), source, ["k"], {"v": "w"})) == [(1, None, 10), (2, "b", 20), (None, "n", 0)]


def test_delete_and_update_keep_null_predicates(spark):
    assert rows(M.delete_where(target(spark), F.col("k") > 1)) == [(1, "a", 10), (None, "n", 0)]
    assert rows(M.update_where(target(spark), F.col("k") > 1, {"extra": F.lit(5)})) == [(1, "a", 10), (2, "b", 5), (None, "n", 0)]


def log(spark):
    return spark.createDataFrame(
        [(0, "U", 1, "a"), (0, "U", 2, "b"), (1, "U", 1, "A"), (2, "D", 1, None), (3, "U", 3, "c"), (4, "U", 1, "again")], "version INT, op STRING, k INT, v STRING"
    )


def test_versions(spark):
    assert rows(M.as_of(log(spark), ["k"], 0)) == [(1, "a"), (2, "b")]
    assert rows(M.as_of(log(spark), ["k"], 1)) == [(1, "A"), (2, "b")]
    assert rows(M.as_of(log(spark), ["k"], 2)) == [(2, "b")]
    assert rows(M.as_of(log(spark), ["k"])) == [(1, "again"), (2, "b"), (3, "c")]
    back = M.restore(log(spark), ["k"], 0, 5)
    assert rows(M.as_of(back, ["k"])) == [(1, "a"), (2, "b")] and rows(M.as_of(back, ["k"], 4)) == rows(M.as_of(log(spark), ["k"], 4))
    folded = M.drop_superseded(log(spark), ["k"], 2)
    assert folded.count() < log(spark).count()
    assert all(rows(M.as_of(folded, ["k"], v)) == rows(M.as_of(log(spark), ["k"], v)) for v in (2, 3, 4))
    assert rows(M.reinsert(M.as_of(log(spark), ["k"], 2), log(spark), ["k"], 1, F.col("k") == 1)) == [(1, "A"), (2, "b")]
    assert rows(M.history(log(spark)))[0] == (0, "U", 2)


def test_schema_enforcement_lists_differences(spark):
    path = scratch(spark, "t")
    target(spark).write.parquet(path)
    wrong = spark.createDataFrame([(1, 2, 3)], "k BIGINT, v INT, new INT")
    with pytest.raises(M.SchemaMismatch) as error:
        M.append_enforced(spark.read.parquet(path), wrong, path)
    assert len(error.value.differences) == 4
    M.append_enforced(spark.read.parquet(path), target(spark), path)
    assert spark.read.parquet(path).count() == 6
    assert rows(M.append_evolving(spark.createDataFrame([(7, 1)], "k INT, score INT"), path).where("k IN (1, 7)"))[0] == (1, "a", 10, None)


def test_compaction_and_clustering_keep_content(spark):
    df = spark.range(4000).select("id", (F.xxhash64("id") % 1000).alias("h"))
    path, small, clustered = (scratch(spark, x) for x in ("many", "few", "clustered"))
    df.repartition(16).write.parquet(path)
    assert files.manifest(spark, path).count() == 16
    assert rows(M.compact(spark, path, small)) == rows(df) and files.manifest(spark, small).count() == 1
    out = M.write_clustered(df, clustered, ["id", "h"], 16)
    assert rows(out) == rows(df)
    spans = out.groupBy(F.col("_metadata.file_path")).agg((F.max("id") - F.min("id")).alias("a"), (F.max("h") - F.min("h")).alias("b")).collect()
    # each file covers about a quarter of either column, unlike a sort by one of them
    assert sum(r["a"] for r in spans) / len(spans) < 2200 and sum(r["b"] for r in spans) / len(spans) < 1100


def test_copy_into_loads_each_file_once(spark):
    source, target_path, ledger = (scratch(spark, x) for x in ("src", "tgt", "ledger"))
    for part in (0, 1):
        spark.range(part * 10, part * 10 + 10).coalesce(1).write.mode("append").json(source)
        assert incremental.copy_into(spark, source, target_path, ledger, "json", "id BIGINT") == 10
    assert incremental.copy_into(spark, source, target_path, ledger, "json", "id BIGINT") == 0
    assert spark.read.parquet(target_path).count() == 20


def test_commented_csv(spark):
    path = scratch(spark, "csv")
    spark.createDataFrame([("code,value\n# remark\na,1\n#b,2\nc,3",)], "value STRING").coalesce(1).write.text(path)
    assert rows(files.read_commented_csv(spark, path)) == [("a", 1), ("c", 3)]


def test_error_if_exists_and_empty(spark):
    path = scratch(spark, "once")
    files.write_table(target(spark), path)
    with pytest.raises(Exception, match="(?i)already exists"):
        files.write_table(target(spark), path)
    empty = files.write_empty_like(target(spark), scratch(spark, "none"))
    assert empty.count() == 0 and empty.schema == target(spark).schema


def test_bins_are_first_fit_decreasing():
    rng = random.Random(3)
    for _ in range(50):
        sizes = [rng.randint(1, 60) for _ in range(rng.randint(0, 40))]
        bins = M.bins_by_size(sizes, 50)
        assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
        assert all(sum(sizes[i] for i in b) <= 50 or len(b) == 1 for b in bins)
        loads = [sum(sizes[i] for i in b) for b in bins]
        assert sum(load <= 25 for load in loads) <= 1  # two bins at most half full would be one


def test_compaction_reads_only_small_files(spark):
    path, out = scratch(spark, "files"), scratch(spark, "compacted")
    spark.range(200_000).selectExpr("id", "uuid() AS u").coalesce(1).write.parquet(path)
    large = {r["file_path"] for r in files.manifest(spark, path).collect()}
    limit = files.manifest(spark, path).first()["file_size"]
    spark.range(200_000, 230_000).selectExpr("id", "uuid() AS u").repartition(7).write.mode("append").parquet(path)
    before = {r["id"]: r["u"] for r in spark.read.parquet(path).collect()}
    made = M.compacted_files(spark, path, out, target_bytes=limit)
    names = {r["file_path"] for r in made.collect()}
    assert large < names and len(names) == 2 and {r["id"]: r["u"] for r in M.read_files(made).collect()} == before
    again = M.compacted_files(spark, out, scratch(spark, "compacted"), target_bytes=limit)  # one small file alone stays
    assert {r["file_path"] for r in again.collect()} == names - large


def test_clusters_of_text_and_dates_prune_files(spark):
    rows_in = spark.range(8000).selectExpr("id", "concat('n', lpad(pmod(xxhash64(id), 5000), 4, '0')) AS name", "date_add(DATE '2020-01-01', cast(pmod(xxhash64(id, 1), 900) AS int)) AS day", "if(id % 50 = 0, NULL, 'x') AS gap")
    path = scratch(spark, "clustered")
    back = M.write_clustered(rows_in, path, ["name", "day"], 16)
    assert rows(back) == rows(rows_in)
    spans = back.withColumn("f", F.input_file_name()).groupBy("f").agg(F.min("name").alias("a"), F.max("name").alias("b"), F.min("day").alias("c"), F.max("day").alias("d"))
    hits = [spans.where("a <= 'n0999' AND b >= 'n0990'").count(), spans.where("c <= DATE '2020-02-10' AND d >= DATE '2020-02-01'").count()]
    assert spans.count() == 16 and max(hits) <= 10, hits
    keyed = M.cluster_key(rows_in, ["gap", "name"])
    assert keyed.where("gap IS NULL").count() == 160 and keyed.select("_z").distinct().count() > 100
    order = M.cluster_key(rows_in, ["name"]).orderBy("name").select("_z").collect()
    assert [r[0] for r in order] == sorted(r[0] for r in order)


def test_many_batches_count_every_row(spark):
    source = scratch(spark, "src")
    spark.range(260).repartition(130).write.parquet(source)
    n = len([1 for _ in files.manifest(spark, source).collect()])
    loaded = incremental.copy_into(spark, source, scratch(spark, "to"), scratch(spark, "ledger"), "parquet", "id LONG", files_per_trigger=1)
    assert n > 100 and loaded == 260
