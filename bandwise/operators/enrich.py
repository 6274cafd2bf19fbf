"""Dimension joins and flags: price sensitivity, tier, welfare branches, weather.

Joins take ``how`` (default ``left``; the original module's earlier INNER versions
are ``how="inner"``). Fact-sized dimensions (price sensitivity, tier) are
joined without a hint, small ones too: the planner and AQE choose broadcast or
sort-merge from actual bytes, and AQE splits skewed keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandwise.functions.calendar import as_date, cast_to, normalise_codes


def price_sensitivity_dim(ps: DataFrame) -> DataFrame:
    """Raw (Branch, MaterialCode, f0_) -> (BC2, MC2, Price_Sensitivity), codes as int."""
    rest = [c for c in ps.columns if c not in ("Branch", "MaterialCode", "f0_")]
    return ps.select(
        cast_to(ps, "Branch", "int").alias("BC2"),
        cast_to(ps, "MaterialCode", "int").alias("MC2"),
        F.col("f0_").alias("Price_Sensitivity"),
        *rest,
    )


def tier_dim(tier: DataFrame) -> DataFrame:
    """Raw (BranchCode, MaterailCode, CALYEAR, CALMONTH, ...) -> (BC3, MC3, CALYEAR, CALMONTH, ...).

    Codes and the year/month keys become int (lenient: bad text -> NULL, so a
    text file never makes the join compare strings with ints).
    """
    keys = ("BranchCode", "MaterailCode", "CALYEAR", "CALMONTH")
    rest = [c for c in tier.columns if c not in keys]
    return tier.select(
        cast_to(tier, "BranchCode", "int").alias("BC3"),
        cast_to(tier, "MaterailCode", "int").alias("MC3"),
        *[cast_to(tier, c, "int").alias(c) for c in ("CALYEAR", "CALMONTH") if c in tier.columns],
        *rest,
    )


_SALT = "_salt"
MOST_HOT_KEYS = 1000  # keys that can be salted at once (the most frequent ones); bounds a broadcast


def hot_keys(fact: DataFrame, keys: list[str], share: float) -> DataFrame:
    """The keys that hold more than ``share`` of all rows, NULL keys aside; at most MOST_HOT_KEYS of them."""
    known = fact.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
    counts = known.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    hot = counts.filter(F.col("_n") > fact.count() * share)
    return hot.orderBy(F.desc("_n"), *keys).limit(MOST_HOT_KEYS).select(*keys)


def salted_join(
    fact: DataFrame, dim: DataFrame, pairs: list[tuple[str, str]], how: str, salt: int, hot_share: float = 0.005
) -> DataFrame:
    """Equi-join ``fact`` to ``dim`` on ``pairs`` (fact column, dim column).

    With ``salt > 1`` (inner and left joins only) the rows of hot keys are spread over ``salt``
    partitions by a hash of the whole row (deterministic, so a retried task sends rows to the same place),
    and only those keys' dimension rows are copied, once for each salt value. A key is hot if it holds more than
    ``hot_share`` of the rows, which one aggregate measures. Rows with a NULL key match nothing: they are
    spread alike, without copies. Use it when one key holds a large share of the fact rows
    and AQE cannot split the join (e.g. the dimension side is computed under the join).
    """
    if salt <= 1:
        cond = None
        for a, b in pairs:
            c = fact[a] == dim[b]
            cond = c if cond is None else cond & c
        return fact.join(dim, cond, how)
    if how not in ("inner", "left", "left_outer", "leftouter"):
        raise ValueError(f"a salted join is inner or left, not {how}")
    keys = [a for a, _ in pairs]
    hot = hot_keys(fact, keys, hot_share)
    names = {a: f"_hot{i}" for i, a in enumerate(keys)}
    marks = F.broadcast(hot.select(*[F.col(a).alias(n) for a, n in names.items()]).withColumn("_is_hot", F.lit(True)))

    def marked(df: DataFrame, columns: list[str]) -> DataFrame:
        cond = F.lit(True)
        for c, a in zip(columns, keys, strict=True):
            cond = cond & (df[c] == F.col(names[a]))
        return df.join(marks, cond, "left").drop(*names.values())

    spread = F.pmod(F.xxhash64(*[F.col(c) for c in fact.columns]), F.lit(salt))
    no_key = F.lit(False)
    for a in keys:
        no_key = no_key | F.col(a).isNull()
    f = marked(fact, keys).withColumn(_SALT, F.when(no_key | F.col("_is_hot"), spread).otherwise(F.lit(0).cast("long"))).drop("_is_hot")
    copies = F.sequence(F.lit(0).cast("long"), F.when(F.col("_is_hot"), F.lit(salt - 1)).otherwise(F.lit(0)).cast("long"))
    d = marked(dim, [b for _, b in pairs]).withColumn(_SALT, F.explode(copies)).drop("_is_hot")
    cond = f[_SALT] == d[_SALT]
    for a, b in pairs:
        cond = cond & (f[a] == d[b])
    return f.join(d, cond, how).drop(f[_SALT]).drop(d[_SALT])


def join_price_sensitivity(
    df: DataFrame, ps: DataFrame, how: str = "left", date_col: str = "SalDate", salt: int = 0
) -> DataFrame:
    """Join on (BranchCode = BC2, MaterialCode = MC2); add YY, MM; codes as int."""
    out = salted_join(df, ps, [("BranchCode", "BC2"), ("MaterialCode", "MC2")], how, salt)
    d = as_date(out, date_col)
    return normalise_codes(out.withColumns({"YY": F.year(d), "MM": F.month(d)}))


def join_tier(df: DataFrame, tier: DataFrame, how: str = "left", salt: int = 0) -> DataFrame:
    """Join on (BranchCode, MaterialCode, YY, MM) = (BC3, MC3, CALYEAR, CALMONTH)."""
    pairs = [("BranchCode", "BC3"), ("MaterialCode", "MC3"), ("YY", "CALYEAR"), ("MM", "CALMONTH")]
    return salted_join(df, tier, pairs, how, salt)


def welfare_branch_flag(df: DataFrame, welfare: DataFrame, branch_col: str = "BranchCode") -> DataFrame:
    """welfareFlag = '1' when the branch is in ``welfare.branchcode``, else '0' (NULL branch -> '0').

    The original module collects the branch list to the driver and inlines it; here
    the distinct codes are a join side.
    """
    keys = welfare.select(cast_to(welfare, "branchcode", "int").alias("_wf_branch")).distinct()
    keys = keys.withColumn("_wf_hit", F.lit(True))
    out = df.join(keys, df[branch_col] == F.col("_wf_branch"), "left")
    return out.withColumn("welfareFlag", F.when(F.col("_wf_hit"), F.lit("1")).otherwise(F.lit("0"))).drop(
        "_wf_branch", "_wf_hit"
    )


def join_weather(df: DataFrame, weather: DataFrame, how: str = "left") -> DataFrame:
    """Join per-branch weather (BranchCode, ...) on BranchCode."""
    if "Branchcode" in weather.columns and "BranchCode" not in weather.columns:
        weather = weather.withColumnRenamed("Branchcode", "BranchCode")
    if "Branchcode" in df.columns and "BranchCode" not in df.columns:
        df = df.withColumnRenamed("Branchcode", "BranchCode")
    return df.join(weather, "BranchCode", how)
