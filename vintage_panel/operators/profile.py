"""Profile columns of booked accounts: channel, behaviour, score bands, fallback score."""

from __future__ import annotations


from pyspark.sql import DataFrame, functions as F

from ..functions import codes
from ..functions.scalars import band, map_labels, score_fallback
from .population import latest_per_key
from .skew import NO_HOT_KEYS, lookup_join


def profile(
    base: DataFrame,
    apps: DataFrame,
    scores: DataFrame,
    *,
    key: str = "account_id",
    apps_key: str = "account_id",
    external_id: str = "ext_id",
    created: str = "created",
    tie: tuple[str, ...] = ("app_id",),
    channel: str = "channel",
    behaviour: str = "rv80",
    vantage: str = "vantage",
    score: str = "pscore",
    dedupe: bool = True,
    hot: DataFrame | tuple | None = None,
) -> DataFrame:
    """``base`` plus profile columns from its application and the second score table.

    ``dedupe`` keeps the newest application per account, so ``base`` rows are not
    multiplied; without it every application of the account gives a row.
    """
    wanted = [apps_key, external_id, created, *tie, behaviour, vantage, score]
    facts = apps.select(*dict.fromkeys([*wanted, channel])).filter(F.col(apps_key).isNotNull())
    if dedupe:
        facts = latest_per_key(facts, [apps_key], created, tie)
    facts = facts.select(
        F.col(apps_key).alias(key),
        F.col(external_id).alias("__ext"),
        F.col(channel).alias("__channel"),
        F.col(behaviour).alias("__behaviour"),
        F.col(vantage).alias("__vantage"),
        F.col(score).alias("__score"),
    )
    second = scores.select(F.col(external_id).alias("__ext"), F.col("score").alias("__second"))
    # join the two small sides first: the base is then shuffled once
    facts = lookup_join(facts, second, "__ext", hot=NO_HOT_KEYS if dedupe else None)
    return lookup_join(base, facts, key, hot=hot).select(
        *base.columns,
        map_labels(
            F.col("__channel"), codes.PROFILE_CHANNELS, codes.PROFILE_CHANNEL_DEFAULT
        ).alias("channels"),
        map_labels(F.col("__behaviour"), codes.BEHAVIOUR_CODES, codes.BEHAVIOUR_DEFAULT).alias(
            "behaviour_indicator"
        ),
        band(F.col("__vantage"), codes.SCORE_BANDS_4, codes.SCORE_BANDS_4_DEFAULT).alias("vband2"),
        band(F.col("__vantage"), codes.SCORE_BANDS_6, codes.SCORE_BANDS_6_DEFAULT).alias("vband1"),
        score_fallback(F.col("__score"), F.col("__second")).alias("final_score"),
    )
