"""Synthetic developer survey with a planted effect, drawn from row keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.functions.hashing import standard_normal, uniform, weighted_choice
from tabwright.functions.numbers import clip, linear_score, round_half_even

# Categories, shares and effect sizes of the survey.
AI_SELECT = ["Yes", "No, and I don't plan to", "No, but I plan to soon"]
AI_SELECT_SHARE = [0.55, 0.35, 0.10]
REMOTE_WORK = ["Remote", "In-person", "Hybrid (some remote, some in-person)"]
REMOTE_WORK_SHARE = [0.50, 0.20, 0.30]
ED_LEVEL = [
    "Bachelor’s degree (B.A., B.S., B.Eng., etc.)",
    "Master’s degree (M.A., M.S., M.Eng., MBA, etc.)",
    "Primary/elementary school",
]
YEARS_MEAN, YEARS_STD, YEARS_RANGE = 7.0, 4.0, (1.0, 35.0)
SALARY_BASE, SALARY_PER_YEAR, SALARY_BONUS, SALARY_STD = 55000.0, 3500.0, 16000.0, 15000.0
SALARY_RANGE = (25000.0, 300000.0)
SCORE_MEAN, SCORE_STD, SCORE_BONUS, SCORE_RANGE = 6.2, 1.8, 1.3, (1.0, 10.0)
BLANK_SHARE, REPEATED_ROWS = 0.08, 25


def synthetic_survey(keys: DataFrame, key: str, seed: int = 42, repeated: int = REPEATED_ROWS) -> DataFrame:
    """One survey row per key, some salaries blank, and the first ``repeated`` keys twice.

    The same key and seed give the same row on any cluster. Shares and distributions
    are fixed; a blank falls on each row with probability ``BLANK_SHARE``.
    """
    k = F.col(key)
    drawn = keys.select(
        k.alias("_key"),
        weighted_choice(uniform(k, seed, "ai"), AI_SELECT, AI_SELECT_SHARE).alias("AISelect"),
        weighted_choice(uniform(k, seed, "remote"), REMOTE_WORK, REMOTE_WORK_SHARE).alias("RemoteWork"),
        weighted_choice(uniform(k, seed, "ed"), ED_LEVEL, [1 / 3] * 3).alias("EdLevel"),
        clip(F.lit(YEARS_MEAN) + standard_normal(k, seed, "years") * YEARS_STD, *YEARS_RANGE).alias("YearsCodePro"),
        (standard_normal(k, seed, "pay") * SALARY_STD).alias("_pay_noise"),
        (standard_normal(k, seed, "score") * SCORE_STD).alias("_score_noise"),
        (uniform(k, seed, "blank") < BLANK_SHARE).alias("_blank"),
    )
    uses = F.col("AISelect") == AI_SELECT[0]
    pay = (
        linear_score(SALARY_BASE, {"YearsCodePro": SALARY_PER_YEAR})
        + F.when(uses, SALARY_BONUS).otherwise(0.0)
        + F.col("_pay_noise")
    )
    score = F.lit(SCORE_MEAN) + F.col("_score_noise") + F.when(uses, SCORE_BONUS).otherwise(0.0)
    rows = drawn.select(
        "_key",
        "AISelect",
        "RemoteWork",
        "EdLevel",
        "YearsCodePro",
        F.when(~F.col("_blank"), clip(pay, *SALARY_RANGE)).alias("ConvertedCompYearly"),
        clip(round_half_even(score), *SCORE_RANGE).alias("JobSat"),
    )
    again = rows.orderBy("_key").limit(repeated)
    return rows.unionByName(again).withColumnRenamed("_key", key)


def survey_of_size(spark: SparkSession, n: int, seed: int = 42) -> DataFrame:
    """A survey of ``n`` rows plus the repeated ones, without the key."""
    return synthetic_survey(spark.range(n), "id", seed).drop("id")
