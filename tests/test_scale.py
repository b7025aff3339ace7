"""Plans and skew: what must hold when the data is a thousand times larger."""

import re

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from catalog import QUERIES
from framewright.functions.chance import shuffle_key
from framewright.operators import boxes, nearest, palette, pool, ranking, scenes
from framewright.session import pin

SF = "/root/testdata/sf0.001"
JVM_ONLY = (
    "jn04_box_verdicts", "ag05_frame_fates", "ag03_frame_report", "jn05_pending_boxes", "jn06_frames_without_boxes",
    "wn02_stratified_split", "wn01_scene_numbers", "flt09_line_findings", "ag16_scorecard", "ag18_run_comparison",
    "prj13_trust_verdict", "ag25_brand_palettes", "ag27_adjacency_fine", "prj21_box_iou", "jn01_labelled_samples",
)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", JVM_ONLY)
def test_core_queries_stay_in_the_jvm_without_cross_joins(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert not re.search("Python|Pandas", text)
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_scans_read_only_what_they_need(spark):
    text = plan(QUERIES["ag03_frame_report"](spark, SF))
    read = " ".join(re.findall(r"ReadSchema: struct<([^>]*)>", text))
    assert "l_suppkey" in read and "l_shipdate" not in read and "l_tax" not in read and "o_totalprice" not in read
    assert "text" not in " ".join(re.findall(r"ReadSchema: struct<([^>]*)>", plan(QUERIES["wn02_stratified_split"](spark, SF))))
    assert re.search(r"PushedFilters: \[[^\]]*l_tax", plan(QUERIES["jn04_box_verdicts"](spark, SF)))


def test_a_hot_group_is_ranked_in_many_slices(spark):
    rows = spark.range(20_000).select(F.col("id").alias("key"), F.when(F.col("id") % 3 < 2, "hot").otherwise(F.col("id").cast("string")).alias("g"))
    slices = rows.groupBy("g", F.substring(shuffle_key(0, "key"), 1, 3).alias("s")).count()
    assert slices.agg(F.max("count")).first()[0] < 40
    ranked = ranking.shuffled_rank(rows, "key", groups=["g"])
    hot = ranked.filter("g = 'hot'").agg(F.count("*"), F.countDistinct("rank"), F.min("rank"), F.max("rank")).first()
    assert hot[0] == hot[1] == hot[3] and hot[2] == 1


def test_a_hot_group_spreads_over_ranges(spark):
    rows = spark.range(20_000).select(F.col("id").alias("key"), F.lit("hot").alias("g"))
    ranked = ranking.ordered_rank(rows, ["key"], groups=["g"])
    assert ranked.filter(F.col("rank") != F.col("key") + 1).count() == 0
    spread = pin(rows.repartitionByRange(4, "g", "key")).groupBy(F.spark_partition_id()).count()
    assert spread.count() == 4


def test_dedupe_with_one_key_on_a_third_of_the_rows(spark):
    rows = spark.range(6000).select(
        F.col("id").alias("at"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("stem"),
        F.col("id").cast("string").alias("mark"),
    )
    assert pool.first_wins(rows, ["at"], ["stem", "mark"]).count() == 4001


def test_a_crowd_of_copies_costs_one_link_each(spark):
    # a third of all vectors are near copies of one: they hang on a pivot, no pair of them is listed
    noise = lambda k: F.rand(k) * 2 - 1
    crowd = F.col("id") % 3 == 0
    parts = [F.when(crowd, F.lit(1.0 if k == 0 else 0.0) + noise(k) * 0.01).otherwise(noise(k)).cast("float") for k in range(12)]
    rows = pin(spark.range(3000).select("id", F.array(*parts).alias("vector")))
    groups = nearest.duplicate_groups(rows, threshold=0.97, block=256)
    sizes = groups.groupBy("group").count().orderBy(F.desc("count")).first()
    assert sizes["count"] >= 1000 and sizes["group"] == 0


def _boxes_of_files(spark, seed):
    """Files of 1 to 40 boxes, some of which overlap."""
    rows = spark.range(1200).withColumn("n", F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1_000_000)))
    file = F.when(F.col("id") < 200, F.floor(F.col("id") / 40)).otherwise(F.floor(F.col("id") / 3))
    return rows.select(
        F.format_string("b%07d-%d", "n", "id").alias("id"), F.concat(F.lit("f"), file.cast("string")).alias("file"), (F.col("n") % 7 / 20.0 + 0.2).alias("cx"),
        (F.col("n") % 11 / 40.0 + 0.2).alias("cy"), (F.col("n") % 3 / 30.0 + 0.3).alias("w"), (F.col("n") % 5 / 50.0 + 0.3).alias("h"),
    )


def test_one_full_file_compares_neighbours_only(spark):
    rows = spark.range(3000).select(
        F.col("id").cast("string").alias("id"), F.lit("hot").alias("file"),
        (F.col("id") / 3000.0).alias("cx"), F.lit(0.5).alias("cy"), F.lit(0.01).alias("w"), F.lit(0.1).alias("h"),
    )
    pairs = boxes.overlap_pairs(rows, rows, iou_min=0.6)
    join = [line for line in plan(pairs).splitlines() if "Join" in line][0]
    assert "_cell" in join and "SortMergeJoin" in join
    assert pairs.count() < 3000 * 20


def test_files_of_usual_size_are_shuffled_once_for_a_merge(spark, tmp_path):
    base, extra = (_boxes_of_files(spark, seed).repartition(3) for seed in (0, 1))
    for df, name in ((base, "base"), (extra, "extra")):
        df.write.parquet(f"{tmp_path}/{name}")
    base, extra = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("base", "extra"))
    merged = boxes.merge_scans(base, extra)
    assert plan(merged).count("Exchange") == 1 and "Join" not in plan(merged)


def test_merging_files_whole_equals_bands(spark, monkeypatch):
    base, extra = _boxes_of_files(spark, 0), _boxes_of_files(spark, 1)
    numbered = base.select((F.row_number().over(W.orderBy("id"))).alias("number"), "file", F.lit(4).alias("index"), *boxes.SIDES, F.lit(0.5).alias("confidence"))
    extra = extra.withColumn("confidence", F.lit(0.25))

    def both():
        merged = boxes.merged_scan(numbered, extra).select("number", "file", "index", "added")
        return sorted(r["id"] for r in boxes.merge_scans(base, extra).collect()), sorted(map(tuple, merged.collect()))

    whole = both()
    assert 0 < len(whole[0]) < extra.count()
    monkeypatch.setattr(boxes, "PAIRS_AT_ONCE", 50)
    assert both() == whole
    for crowd in (20, 0):  # some files by bands, all files by bands
        monkeypatch.setattr(boxes, "CROWD", crowd)
        assert both() == whole


def test_a_crowd_of_equal_boxes_is_compared_once(spark, monkeypatch):
    sizes = []
    monkeypatch.setattr(boxes, "overlap_pairs", lambda a, b, pairs=boxes.overlap_pairs, **k: sizes.append((a.count(), b.count())) or pairs(a, b, **k))
    crowd = spark.range(100_000).select(
        F.format_string("e%06d", "id").alias("id"), F.lit("a").alias("file"), F.lit(0.5).alias("cx"), F.lit(0.5).alias("cy"),
        F.lit(0.2).alias("w"), F.lit(0.2).alias("h"), (F.col("id") / 1e5).alias("confidence"),
    )
    assert [r["id"] for r in boxes.merge_scans(crowd.limit(0), crowd).collect()] == ["e000000"]
    assert boxes.merge_scans(crowd, crowd).count() == 0
    hits = boxes.matched_detections(crowd, crowd, steps=(0.5,)).collect()
    assert [r["id"] for r in hits] == ["e099999"]
    assert max(a for pair in sizes for a in pair) <= 1


def test_scenes_of_one_long_recording_are_cut_in_spans(spark):
    frames = spark.range(50_000).select(F.lit(1).alias("recording"), (F.col("id") / 10.0).alias("seconds"), F.col("id").cast("string").alias("file"))
    out = scenes.number_scenes(frames, gap=60.0)
    assert out.agg(F.max("scene")).first()[0] == 1
    assert frames.groupBy(F.floor(F.col("seconds") / 600)).count().agg(F.max("count")).first()[0] == 6000


def test_membership_reads_the_points_once(spark):
    pts = spark.range(10).select(F.lit(1).alias("img"), *[F.col("id").alias(c) for c in ("x", "y")], F.lit(8).alias("width"), F.lit(8).alias("height"), *[F.col("id").cast("double").alias(c) for c in ("L", "a", "b")])
    text = plan(palette.cell_sums(palette.membership(pts)))
    assert text.count("Exchange") == 1 and "Join" not in text
