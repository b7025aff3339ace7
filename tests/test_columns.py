from pyspark.sql import functions as F

from framewright import schemas as C
from framewright.functions.decimals import fixed
from framewright.functions import answers as A
from framewright.functions import geometry as G
from framewright.functions import naming as N
from framewright.functions.chance import uniform


def one(df, column):
    return df.select(column.alias("v")).first()["v"]


def test_label_line_inside_and_over_the_edge(frame):
    df = frame([(10.0, 20.0, 50.0, 60.0, 100, 200)], "x1 double, y1 double, x2 double, y2 double, w int, h int")
    cols = [F.col(c) for c in ("x1", "y1", "x2", "y2", "w", "h")]
    assert one(df, G.label_line(*G.clamped_shares(*cols).values())) == "0 0.300000 0.200000 0.400000 0.200000"
    over = frame([(-10.0, 0.0, 110.0, 200.0, 100, 200)], "x1 double, y1 double, x2 double, y2 double, w int, h int")
    assert one(over, G.label_line(*G.clamped_shares(*cols).values())) == "0 0.500000 0.500000 1.000000 1.000000"
    assert one(over, G.shares(*cols)["w"]) == 1.2


def test_groups_of_file_names(frame):
    names = {
        "video_hard_000187.jpg": "video_hard",
        "billboard_ad_052.jpg": "billboard_ad",
        "3f9c1a2b8e04.jpg": "raw",
        "3F9C1A2B8E04AA.PNG": "raw",
        "351.png": "numbers",
        "photo.jpg": "photo",
        "a.b_12.jpg": "a.b",
    }
    df = frame([(n,) for n in names], "file string")
    got = {r["file"]: r["g"] for r in df.select("file", N.group_of(F.col("file")).alias("g")).collect()}
    assert got == names


def test_video_moment(frame):
    rows = [("frame_001336_t00053.440.jpg",), ("frame_000001_t00000.000.jpg",), ("photo_001.jpg",), ("frame_000005_t00002.0.jpg",)]
    df = frame(rows, "file string").select("file", *[v.alias(k) for k, v in N.video_moment(F.col("file")).items()])
    got = {r["file"]: (r["recording"], r["seconds"]) for r in df.collect()}
    assert got[rows[0][0]] == (25, 53.44)
    assert got[rows[1][0]] == (None, None) and got[rows[2][0]] == (None, None)
    assert got[rows[3][0]][0] == 2  # 2.5 rounds half-even


def test_pair_keys_join_copies_to_originals(frame):
    df = frame([("truck_00001.jpg",), ("truck_00001_aug.jpg",), ("truckaug_00001.jpg",), ("00001.webp",)], "file string")
    keys = {r["k"] for r in df.select(N.pair_key(F.col("file")).alias("k")).collect()}
    assert keys == {"truck_00001", "00001"}  # a bare number is another frame
    assert [r["c"] for r in df.select(N.is_copy(F.col("file")).alias("c")).collect()] == [False, True, True, False]


def test_crop_is_never_empty_and_stays_inside(frame):
    df = frame([(0.0, 0.0, 0.0, 0.0), (0.99, 0.5, 0.2, 0.5), (1.3, -0.4, 0.1, 0.1)], "cx double, cy double, w double, h double")
    box = G.crop_window(*[F.col(c) for c in ("cx", "cy", "w", "h")], F.lit(100), F.lit(50), margin=0.1, max_side=20)
    for r in df.select(*[v.alias(k) for k, v in box.items()]).collect():
        assert 0 <= r["left"] < r["right"] <= 100 and 0 <= r["top"] < r["bottom"] <= 50
        assert 0 < r["scale"] <= 1


def test_decimals_round_the_exact_binary_value(spark):
    values = [0.12345, 1.00005, 0.43215, 0.5, 0.25, 0.125, 2.5, 0.0, -0.12345, -2.5, 1e-9, 123456.654321]
    values += [k / 10_000 + 0.00005 for k in range(3000)] + [k / 64 for k in range(200)]
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    for n in (2, 4, 6):
        got = [r[0] for r in rows.select(fixed(F.col("v"), n)).collect()]
        assert [g.replace("-0.0000", "0.0000") for g in got if float(g) or True] == [f"{v:.{n}f}".replace("-0.0000", "0.0000") for v in values]


def test_letterbox_centres(frame):
    df = frame([(400, 100)], "w int, h int")
    row = df.select(*[v.alias(k) for k, v in G.letterbox(F.col("w"), F.col("h"), 224).items()]).first()
    assert (row["new_width"], row["new_height"], row["offset_x"], row["offset_y"]) == (224, 56, 0, 84)


TRUST = [
    # brand, basis, text, error, verdict, decided, with logo
    ("mts", "name_read", "Новый тариф МТС", "", "confirmed", "mts", "mts"),
    ("mts", "logo_only", "М Т С", "", "confirmed", "mts", "mts"),
    ("mts", "logo_only", "М Т С", "", "confirmed", "mts", "mts"),
    ("mts", "name_read", "тариф", "", "review", "unclear", "mts"),
    ("mts", "colors_only", "МТС", "", "rejected", "unclear", "unclear"),
    ("tele2", "logo_only", "кабинет 2", "", "review", "unclear", "tele2"),
    ("tele2", "logo_only", "новый t2", "", "confirmed", "tele2", "tele2"),
    ("plus7", "logo_only", "Телеком", "", "confirmed", "plus7", "plus7"),
    ("plus7", "logo_only", "Ростелеком", "", "review", "unclear", "plus7"),
    ("plus7", "logo_only", "+7 телеком", "", "confirmed", "plus7", "plus7"),
    ("other", "colors_only", "", "", "confirmed", "other", "other"),
    ("unclear", "colors_only", "", "timeout", "confirmed", "unclear", "unclear"),
]


def test_trust_table(frame):
    df = frame([t[:4] for t in TRUST], "brand string, basis string, text string, error string")
    verdict = A.trust(*[F.col(c) for c in ("brand", "basis", "text", "error")])
    rows = df.withColumn("v", verdict).select(
        "v", A.decided(F.col("brand"), F.col("v")).alias("d"), A.decided(F.col("brand"), F.col("v"), accept_logo=True).alias("l")
    )
    assert [tuple(r) for r in rows.collect()] == [t[4:] for t in TRUST]


def test_replies_with_defaults_and_failures(frame):
    rows = [
        ('{"brand":"mts","basis":"name_read","visible_text":"a\\nb","evidence":"e"}', None),
        ('{"brand":"mts"}', None),
        ("{cut off", None),
        (None, "HTTP 500"),
    ]
    df = frame(rows, "reply string, failure string")
    got = df.select(*[v.alias(k) for k, v in A.parse_brand_reply(F.col("reply"), F.col("failure")).items()]).collect()
    assert tuple(got[0]) == ("mts", "name_read", "e", "a\nb", "")
    assert tuple(got[1]) == ("mts", "colors_only", "", "", "")
    assert got[2]["brand"] == "unclear" and got[2]["error"]
    assert got[3]["error"] == "HTTP 500"
    long = frame([(None, "x" * 500), ('{"category":"road_sign","reason":"%s"}' % ("y" * 300), None)], "reply string, failure string")
    judged = long.select(*[v.alias(k) for k, v in A.parse_judge_reply(F.col("reply"), F.col("failure")).items()]).collect()
    assert judged[0]["category"] == "error" and len(judged[0]["reason"]) == 500
    assert judged[1]["category"] == "road_sign" and len(judged[1]["reason"]) == 300


def test_pick_class_takes_the_first_best_and_respects_the_floor(frame):
    df = frame([([0.4, 0.4, 0.1, 0.1],), ([0.1, 0.2, 0.6, 0.1],)], "p array<double>")
    pick = A.pick_class(F.col("p"), C.HEAD_CLASSES, 0.4)
    assert [r["b"] for r in df.select(pick["brand"].alias("b")).collect()] == ["beeline", "tele2"]
    strict = A.pick_class(F.col("p"), C.HEAD_CLASSES, 0.5)
    assert [r["b"] for r in df.select(strict["brand"].alias("b")).collect()] == ["unsure", "tele2"]


def test_class_index_keeps_the_fixed_order(frame):
    df = frame([("other",), ("beeline",), ("stranger",)], "b string")
    assert [r["i"] for r in df.select(A.class_index(F.col("b")).alias("i")).collect()] == [3, 0, None]


def test_uniform_draws_stay_in_range(spark):
    stats = spark.range(2000).select(uniform(1, F.col("id"), "x").alias("u")).agg(F.min("u"), F.max("u"), F.avg("u")).first()
    assert 0 <= stats[0] < stats[1] < 1 and abs(stats[2] - 0.5) < 0.03


def test_blinded_and_probe_names(frame):
    df = frame([(7, "A/B C", "x.PNG")], "n int, source string, file string")
    row = df.select(N.blinded_name(F.col("n"), F.col("file")), N.probe_name(F.col("source"), F.col("file"))).first()
    assert tuple(row) == ("img_0007.png", "A-B_C__x.PNG")
