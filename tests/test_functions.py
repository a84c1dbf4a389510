import math
import re

import pytest
from pyspark.sql import functions as F

from fieldlake.functions import identity, numeric, temporal, text


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


# Known scores of (field id, time) pairs.
KNOWN_SCORES = [
    ("grid_47.92_-109.92", 0.1022999),
    ("grid_48.3_-110.1", 0.2757166),
    ("grid_39.54_-91.33", 0.8037597),
    ("grid_9.42_-0.97", 0.8234423),
    ("grid_-33.38_151.35", 0.880402),
]


def test_scores_match_known_values(spark):
    rows = spark.createDataFrame(KNOWN_SCORES, "field_id string, expected double")
    score = identity.deterministic_score(F.col("field_id"), F.lit("1970-12-31 00:00:00"))
    for row in rows.withColumn("score", score).collect():
        assert row["score"] == row["expected"]


@pytest.mark.parametrize(
    "lat, lon, expected",
    [
        (47.92, -109.92, "grid_47.92_-109.92"),
        (48.3, -110.1, "grid_48.3_-110.1"),
        (-33.38, 151.35, "grid_-33.38_151.35"),
        (1.23456, None, "grid_1.235_nan"),
        (float("nan"), 2.0, "grid_nan_2.0"),
    ],
)
def test_grid_field_id(spark, lat, lon, expected):
    column = identity.grid_field_id(F.lit(lat).cast("double"), F.lit(lon).cast("double"))
    assert value(spark, column) == expected


@pytest.mark.parametrize(
    "number, expected", [(20.0, 9.0), (1.0, 3.5), (7.0, 7.0), (float("nan"), 9.0), (None, 9.0)]
)
def test_clamp_saturates(spark, number, expected):
    assert value(spark, numeric.clamp(F.lit(number).cast("double"), 3.5, 9.0)) == expected


def test_clip_keeps_null(spark):
    assert value(spark, numeric.clip_lower(F.lit(-1.0), 0.0)) == 0.0
    assert value(spark, numeric.clip_lower(F.lit(None).cast("double"), 0.0)) is None


@pytest.mark.parametrize(
    "raw, expected", [("1.5", 1.5), (" 2 ", 2.0), ("n/a", None), ("", None), ("NaN", None), (None, None)]
)
def test_to_double(spark, raw, expected):
    assert value(spark, numeric.to_double(F.lit(raw).cast("string"))) == expected


def test_row_mean_skips_missing(spark):
    columns = [F.lit("1"), F.lit("x"), F.lit("4")]
    assert value(spark, numeric.row_mean(columns)) == 2.5
    assert value(spark, numeric.row_mean([F.lit("x"), F.lit(None).cast("string")])) is None


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("1998", "1998-01-01 00:00:00"),
        ("1998.0", "1998-01-01 00:00:00"),
        ("2001-02-03", "2001-02-03 00:00:00"),
        ("2001-02-03 04:05:06", "2001-02-03 04:05:06"),
        ("unknown", None),
        ("19980", None),
        (None, None),
    ],
)
def test_parse_timestamp(spark, raw, expected):
    parsed = temporal.parse_timestamp(F.lit(raw).cast("string"))
    assert value(spark, F.date_format(parsed, "yyyy-MM-dd HH:mm:ss")) == expected


@pytest.mark.parametrize(
    "name, plain, strict",
    [
        ("SM2001.tif", 2001, 2001),
        ("sm_v2_1998.tif", 2199, 1998),
        ("nodigits.tif", 2000, 2000),
        ("v12.tif", 2000, 2000),
    ],
)
def test_year_from_name(spark, name, plain, strict):
    assert value(spark, temporal.year_from_name(F.lit(name))) == plain
    assert value(spark, temporal.year_from_name(F.lit(name), strict=True)) == strict


def test_missing_time_reads_nat(spark):
    assert value(spark, temporal.second_text(F.lit(None).cast("timestamp"))) == "NaT"


def test_floor_window(spark):
    moment = F.to_timestamp(F.lit("2024-01-01 10:29:59"))
    floored = temporal.iso_text(temporal.floor_window(moment))
    assert value(spark, floored) == "2024-01-01T10:15:00Z"


@pytest.mark.parametrize(
    "q, tier", [(0.1, "low"), (0.3, "medium"), (0.7, "medium"), (0.71, "high"), (None, None)]
)
def test_tiers(spark, q, tier):
    assert value(spark, numeric.coherence_tier(F.lit(q).cast("double"))) == tier


@pytest.mark.parametrize("share, level", [(0.4, "low"), (0.41, "medium"), (0.7, "medium"), (0.71, "high")])
def test_levels(spark, share, level):
    assert value(spark, numeric.level(F.lit(share))) == level


@pytest.mark.parametrize("raw", ["", "  ", "one", " a b\tc\n", "été nü ", "x\x1cy z"])
def test_word_count_like_python(spark, raw):
    assert value(spark, text.word_count(F.lit(raw))) == len(raw.split())


@pytest.mark.parametrize(
    "raw",
    [
        "Quantum sensors and quantum\nfield; the Quantum",
        "naïve quantum état QUANTUM computing",
        "quantum quantum quantum",
        "",
    ],
)
def test_phrases_like_python(spark, raw):
    expected = [re.findall(p, raw, re.IGNORECASE) for p in (r"quantum\s+\w+", r"\w+\s+quantum")]
    found = [value(spark, text.find_all(F.lit(raw), p)) for p in text.phrase_patterns("quantum")]
    assert found == expected


def test_small_text_functions(spark):
    assert value(spark, text.title_words(F.lit("quantum_clock_sync"))) == "Quantum Clock Sync"
    assert value(spark, numeric.binary_to_long(F.lit("101"))) == 5
    assert value(spark, numeric.hex_to_long(F.lit("ff"))) == 255
    assert value(spark, text.fixed_text(F.lit(1.5))) == "1.500"


def test_draws_are_multiples_within_bounds(spark):
    q = identity.mean_of_draws(F.col("id"))
    rows = spark.range(2000).select(q.alias("q")).collect()
    assert all(0 <= r["q"] <= 1 and abs(r["q"] * 448 - round(r["q"] * 448)) < 1e-9 for r in rows)


@pytest.mark.parametrize("bits, draws", [(1, 10), (3, 64), (4, 100), (2, 129)])
def test_draws_have_the_uniform_mean_and_spread(spark, bits, draws):
    q = identity.mean_of_draws(F.col("id"), bits, draws)
    stats = spark.range(20000).select(q.alias("q")).agg(F.avg("q"), F.stddev("q")).first()
    top = 2**bits - 1
    spread = math.sqrt((4**bits - 1) / 12 / draws) / top
    assert abs(stats[0] - 0.5) < 5 * spread / math.sqrt(20000)
    assert abs(stats[1] / spread - 1) < 0.03


def test_normals_are_standard_and_uncorrelated(spark):
    digest = F.sha2(F.col("id").cast("string"), 256)
    z = spark.range(20000).select(*[n.alias(f"z{i}") for i, n in enumerate(identity.normals(digest, 5))])
    row = z.agg(
        *[F.avg(f"z{i}").alias(f"m{i}") for i in range(5)],
        *[F.stddev(f"z{i}").alias(f"s{i}") for i in range(5)],
        F.corr("z0", "z1").alias("c01"),
        F.corr("z2", "z4").alias("c24"),
    ).first()
    assert all(abs(row[f"m{i}"]) < 0.035 and abs(row[f"s{i}"] - 1) < 0.03 for i in range(5))
    assert abs(row["c01"]) < 0.035 and abs(row["c24"]) < 0.035


def test_draw_arguments_are_checked():
    with pytest.raises(ValueError):
        identity.mean_of_draws(F.lit(1), 5)
    with pytest.raises(ValueError):
        identity.mean_of_draws(F.lit(1), 3, 0)
