"""Evaluation queries: score variants and build leaderboards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import scorers as S
from ..operators.summary import leaderboard
from ..sources import fixtures as X


def leaderboard_basic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variants x exact-match true fraction and
    mean Jaccard over every document."""
    pairs = X.eval_pairs(spark, sf_dir)
    scored = S.evaluate(pairs, ["exact_match", "jaccard"], keep=["variant"])
    return leaderboard(scored, "variant", [("exact_match", "match.true_fraction"),
                                           ("jaccard", "jaccard.mean")])


LEADERBOARD_BASIC_SQL = X.with_ctes(X.EVAL_PAIRS_SQL, body=r"""
, scored AS (
  SELECT variant,
    lower(trim(regexp_replace(output, '\s+', ' ', 'g'))) =
      lower(trim(regexp_replace(reference, '\s+', ' ', 'g'))) AS em,
    list_filter(string_split_regex(lower(reference), '\s+'), lambda x: x <> '') AS tr,
    list_filter(string_split_regex(lower(output), '\s+'), lambda x: x <> '') AS tout
  FROM eval_pairs)
SELECT variant,
  round(avg(CAST(em AS INTEGER)), 6) AS exact_match_match_true_fraction,
  round(avg(CASE WHEN len(list_distinct(list_concat(tr, tout))) = 0 THEN 0.0
            ELSE len(list_intersect(tr, tout)) / len(list_distinct(list_concat(tr, tout))) END), 6)
    AS jaccard_jaccard_mean,
  count(*) AS n_rows
FROM scored GROUP BY variant
""")


def exact_match_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C2 per row: trim + lower only."""
    pairs = X.eval_pairs(spark, sf_dir)
    return pairs.select("id", "variant", S.get_scorer("exact_match_trim").column(pairs)
                        .getField("match").alias("match"))


EXACT_MATCH_TRIM_SQL = X.with_ctes(X.EVAL_PAIRS_SQL, body=r"""
SELECT id, variant,
  lower(regexp_replace(output, '^\s+|\s+$', '', 'g')) =
  lower(regexp_replace(reference, '^\s+|\s+$', '', 'g')) AS match
FROM eval_pairs
""")
