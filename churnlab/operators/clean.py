"""Projections, predicates, validation, cleaning and encoding.

Fitted steps (medians, modes, one-hot levels, IQR bounds) follow the estimator pattern: ``fit_*``
runs one aggregate and returns a small Python object (one value per column, or the distinct
levels of a low-cardinality column); the transform applies it as literals, so the plan stays a
narrow projection with no join.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..functions.features import drop_matching, flag  # noqa: F401  (P1 lives with the features)
from ..session import checkpoint
from .ordered import column_quantiles, exact_quantiles_long, prefix_sums

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


# ---------------------------------------------------------------- projections / predicates

def drop_if_exists(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop columns, ignoring absent ones."""
    return df.drop(*[c for c in cols if c in df.columns])


def align_features(df: DataFrame, features: list[str], keep: list[str] | None = None) -> DataFrame:
    """Select ``features`` in order; an absent column becomes 0.0 (present NULLs stay NULL)."""
    have = set(df.columns)
    cols = [F.col(c) for c in (keep or []) if c in have]
    cols += [F.col(c) if c in have else F.lit(0.0).alias(c) for c in features]
    return df.select(*cols)


def select_features_label(df: DataFrame, features: list[str], label: str = S.LABEL,
                          keep: list[str] | None = None) -> DataFrame:
    """The selected features plus the label (and any id columns in ``keep``)."""
    return df.select(*(keep or []), *features, label)


def normalize_names(df: DataFrame) -> DataFrame:
    """P5: strip surrounding spaces from column names."""
    return df.toDF(*[c.strip() for c in df.columns])


def rename_display(df: DataFrame) -> DataFrame:
    """Spaced file headers to internal snake_case names (unknown names untouched)."""
    back = {v: k for k, v in S.DISPLAY_NAMES.items()}
    return df.toDF(*[back.get(c.strip(), c.strip()) for c in df.columns])


def map_values(df: DataFrame, col: str, mapping: dict, out: str | None = None) -> DataFrame:
    """Replace values through ``mapping``; unmapped values become NULL."""
    expr = None
    for k, v in mapping.items():
        cond = F.col(col) == F.lit(k)
        expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
    return df.withColumn(out or col, expr)


def require_columns(df: DataFrame, cols: list[str]) -> bool:
    """Raise listing the missing columns; True otherwise."""
    missing = sorted(set(cols) - set(df.columns))
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    return True


def columns_of_type(df: DataFrame, kind: str, exclude: tuple = (S.ID,)) -> list[str]:
    """Numeric or string column names (booleans are not numeric)."""
    out = []
    for f in df.schema.fields:
        if f.name in exclude:
            continue
        if kind == "numeric" and isinstance(f.dataType, NUMERIC_TYPES):
            out.append(f.name)
        elif kind == "string" and isinstance(f.dataType, T.StringType):
            out.append(f.name)
    return out


def validate_requests(df: DataFrame) -> DataFrame:
    """One row per request with ``is_valid`` and the list of broken rules.

    A field is broken when absent, NULL, outside its range, or (plans) not Yes/No. Extra fields
    pass through untouched.
    """
    have = set(df.columns)
    checks = []
    for name, kind, lo, hi in S.REQUEST_FIELDS:
        if name not in have:
            checks.append(F.lit(f"{name}: missing"))
            continue
        c = F.col(name)
        if kind == "yesno":
            bad = c.isNull() | ~c.isin("Yes", "No")
            checks.append(F.when(bad, F.lit(f"{name}: must be Yes or No")))
        else:
            num = c.cast("double")
            bad = num.isNull() | (num < F.lit(lo)) | (num > F.lit(hi))
            if kind == "int":
                bad = bad | (num != F.floor(num))
            checks.append(F.when(bad, F.lit(f"{name}: must be in [{lo}, {hi}]")))
    reasons = F.array_compact(F.array(*checks))
    return df.withColumn("reject_reasons", reasons).withColumn("is_valid", F.size("reject_reasons") == 0)


def filter_customers(df: DataFrame, calls_range: tuple[int, int] | None = None,
                     intl: list[int] | None = None, vmail: list[int] | None = None) -> DataFrame:
    """P10: inclusive range on service calls AND plan memberships (pushed to the scan when possible)."""
    cond = F.lit(True)
    if calls_range is not None:
        cond = cond & F.col("customer_service_calls").between(calls_range[0], calls_range[1])
    if intl is not None:
        cond = cond & F.col("international_plan").isin(list(intl))
    if vmail is not None:
        cond = cond & F.col("voice_mail_plan").isin(list(vmail))
    return df.where(cond)


def risk_indicators(df: DataFrame) -> DataFrame:
    """Rule flags of the scoring form."""
    calls = F.col("customer_service_calls")

    def yes(name: str) -> Column:
        # plans may still be text (Yes/No) or already encoded (1/0)
        if isinstance(df.schema[name].dataType, T.StringType):
            return F.col(name) == F.lit("Yes")
        return F.col(name) == 1

    return df.withColumns({
        "high_service_calls_flag": flag(calls >= 4),
        "intl_plan_flag": flag(yes("international_plan")),
        "low_risk_flag": flag((calls <= 1) & yes("voice_mail_plan")),
    })


def round_outputs(df: DataFrame, cols: list[str], digits: int = 4) -> DataFrame:
    """Round to ``digits`` places (half up)."""
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols})


def churn_band(prob: Column | str, threshold: float = 0.5) -> tuple[Column, Column]:
    """(predicted flag, High/Low label) for a probability column."""
    p = F.col(prob) if isinstance(prob, str) else prob
    pred = F.coalesce(p > F.lit(threshold), F.lit(False))
    return pred, F.when(pred, F.lit("High")).otherwise(F.lit("Low"))


# ---------------------------------------------------------------- duplicates / missing

def data_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c != S.ID]


def dedup_rows(df: DataFrame) -> DataFrame:
    """Drop full-row duplicates over the data columns; the smallest id is kept.

    A grouped aggregate (not ``dropDuplicates``) so the surviving id is deterministic; NULLs
    compare equal, as in the file-based original. Partial aggregation collapses a hot duplicate
    group map-side.
    """
    cols = data_columns(df)
    if S.ID not in df.columns:
        return df.dropDuplicates()
    return df.groupBy(*cols).agg(F.min(S.ID).alias(S.ID)).select(*df.columns)


def duplicate_profile(df: DataFrame) -> DataFrame:
    """Rows, number of repeats after the first, and their percentage."""
    cols = data_columns(df)
    g = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
    return g.agg(
        F.sum("n").cast("bigint").alias("rows"),
        F.sum(F.col("n") - 1).cast("bigint").alias("duplicates"),
    ).withColumn("duplicate_pct", F.round(F.try_divide(F.col("duplicates") * 100.0, F.col("rows")), 6))


def missing_profile(df: DataFrame) -> DataFrame:
    """NULL count and percentage per column, only columns with NULLs, most missing first."""
    cols = data_columns(df)
    wide = df.agg(F.count(F.lit(1)).alias("__rows"),
                  *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = wide.unpivot("__rows", cols, "column", "missing")
    return (long.where(F.col("missing") > 0)
            .select("column", F.col("missing").cast("bigint").alias("missing"),
                    F.round(F.col("missing") * 100.0 / F.col("__rows"), 6).alias("missing_pct"))
            .orderBy(F.desc("missing"), "column"))


def missing_ratio(df: DataFrame) -> DataFrame:
    """NULL cells over all cells (id excluded)."""
    cols = data_columns(df)
    nulls = sum((F.count_if(F.col(c).isNull()) for c in cols), F.lit(0))
    return df.agg(F.round(F.try_divide(nulls, F.count(F.lit(1)) * F.lit(len(cols))), 8).alias("missing_ratio"))


# ---------------------------------------------------------------- imputation / encoding

@dataclass(frozen=True)
class Imputation:
    medians: dict
    modes: dict


def fit_imputation(df: DataFrame) -> Imputation:
    """C4+C5 fit: exact medians of numeric columns and the mode (smallest on ties) of strings.

    Only columns that actually hold NULLs are filled, as in the original. A first aggregate
    counts NULLs per column (cheap, fused into one scan); exact medians and modes are computed
    only for the columns that need them, in one more aggregate, and not at all for a clean table.
    """
    num = columns_of_type(df, "numeric")
    txt = columns_of_type(df, "string")
    if not num + txt:
        return Imputation({}, {})
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in num + txt]).first().asDict()
    need_num = [c for c in num if nulls[c] > 0]
    need_txt = [c for c in txt if nulls[c] > 0]
    if not need_num and not need_txt:
        return Imputation({}, {})
    medians = {c: q[0] for c, q in column_quantiles(df, need_num, [0.5]).items()}
    modes = {}
    if need_txt:
        # counted over the shuffle by (column, value); per column only the best one is kept
        counts = df.unpivot([], need_txt, "column", "value").where(F.col("value").isNotNull()) \
            .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
        best = counts.groupBy("column").agg(F.min_by("value", F.struct(-F.col("n"), "value")).alias("mode"))
        modes = dict.fromkeys(need_txt) | {r["column"]: r["mode"] for r in best.collect()}
    return Imputation(medians, modes)


def apply_imputation(df: DataFrame, imp: Imputation) -> DataFrame:
    fills = {}
    for c, v in imp.medians.items():
        if v is None:
            continue
        dt = df.schema[c].dataType
        if isinstance(dt, (T.FloatType, T.DoubleType, T.DecimalType)) or float(v) != int(v):
            # a fractional median turns an integral column into a double one, as a float fill would
            fills[c] = F.coalesce(F.col(c).cast("double"), F.lit(float(v)))
        else:
            fills[c] = F.coalesce(F.col(c), F.lit(int(v)).cast(dt))
    for c, v in imp.modes.items():
        if v is not None:
            fills[c] = F.coalesce(F.col(c), F.lit(v))
    return df.withColumns(fills) if fills else df


def impute(df: DataFrame, imp: Imputation | None = None) -> DataFrame:
    """C4 + C5."""
    return apply_imputation(df, imp or fit_imputation(df))


def encode_yes_no(df: DataFrame, cols: list[str] = S.PLAN_COLS) -> DataFrame:
    """C6: "Yes" -> 1, anything else (NULL included) -> 0; already numeric columns untouched."""
    out = {}
    for c in cols:
        if c in df.columns and isinstance(df.schema[c].dataType, T.StringType):
            out[c] = flag(F.col(c) == F.lit("Yes"))
    return df.withColumns(out) if out else df


def encode_label(df: DataFrame, label: str = S.LABEL) -> DataFrame:
    """Boolean, numeric or text label to 0/1 INT (text 'true'/'1'/'yes' is positive)."""
    if label not in df.columns:
        return df
    dt = df.schema[label].dataType
    c = F.col(label)
    if isinstance(dt, T.BooleanType):
        e = flag(c)
    elif isinstance(dt, T.StringType):
        e = flag(F.lower(F.trim(c)).isin("true", "1", "yes", "1.0"))
    else:
        e = flag(c != 0)
    return df.withColumn(label, e)


def fit_levels(df: DataFrame, col: str = "state", max_levels: int = 10000) -> list[str]:
    """C8 fit: sorted distinct non-NULL levels (a low-cardinality dimension; size is checked)."""
    levels = [r[0] for r in df.where(F.col(col).isNotNull()).select(col).distinct().orderBy(col)
              .limit(max_levels + 1).collect()]
    if len(levels) > max_levels:
        raise ValueError(f"{col} has more than {max_levels} levels: too many for a column each")
    return levels


def one_hot(df: DataFrame, col: str = "state", levels: list[str] | None = None,
            drop_first: bool = True) -> DataFrame:
    """``<col>_<level>`` 0/1 columns for the fitted levels, first dropped; source dropped.

    A NULL value gives all zeros. A level unseen at fit time also gives all zeros, so a new
    batch never changes the schema. Levels whose safe names are equal ("a b", "a-b") get a column
    each: from the second one on, the level's place among the fitted levels is added to the name.
    """
    if col not in df.columns:
        return df
    levels = fit_levels(df, col) if levels is None else levels
    keep = levels[1:] if drop_first else levels
    plain = {f"{col}_{S.safe_name(lv)}".lower() for lv in levels}  # column names ignore case
    cols, used = {}, set()
    for place, lv in enumerate(levels):
        name = f"{col}_{S.safe_name(lv)}"
        while name.lower() in used or name.lower() in plain and name != f"{col}_{S.safe_name(lv)}":
            name = f"{name}_{place}"
        used.add(name.lower())
        if lv in keep:
            cols[name] = flag(F.col(col) == F.lit(lv))
    return df.withColumns(cols).drop(col)


def level_table(df: DataFrame, col: str = "state") -> DataFrame:
    """C8 fit, any number of levels: (level, pos), distinct non-NULL levels in order from 0, numbered by running sums."""
    levels = df.where(F.col(col).isNotNull()).select(F.col(col).alias("level")).distinct().withColumn("pos", F.lit(1).cast("bigint"))
    return checkpoint(prefix_sums(levels, [], "level", ["pos"], prefix="at_").select("level", (F.col("at_pos") - 1).alias("pos")))


def one_hot_vector(df: DataFrame, col: str = "state", levels: DataFrame | None = None, drop_first: bool = True,
                   out: str | None = None) -> DataFrame:
    """C8 wide form: one sparse vector ``<col>_onehot`` in place of a column per level; source dropped.

    ``levels`` is a ``level_table``, joined to the rows; nothing about the levels but their number reaches the driver.
    Vector place i is level i, or i + 1 with the first one dropped. NULL, an unseen and the dropped
    level give an empty vector. Tables without levels, or with the dropped one alone, get vectors of size 1 that stay empty.
    """
    levels = level_table(df, col) if levels is None else levels
    out = out or f"{col}_onehot"
    n = levels.count()
    size = max(n - 1 if drop_first else n, 1)
    first = 1 if drop_first else 0
    if size >= 2 ** 31 - 1:
        raise ValueError(f"{col} has more levels than a vector has places")
    lookup = levels.where(F.col("pos") >= first).select(F.col("level").alias("__level"), (F.col("pos") - first).alias("__pos"))
    placed = df.join(lookup, F.col(col) == F.col("__level"), "left")
    # the encoder drops its last category: place ``size`` means none
    placed = placed.withColumn("__pos", F.coalesce("__pos", F.lit(size)).cast("double")).drop("__level", col)
    ends = df.sparkSession.range(1).select(F.lit(float(size)).alias("__pos"))
    encoder = OneHotEncoder(inputCols=["__pos"], outputCols=[out], dropLast=True)
    return encoder.fit(ends).transform(placed).drop("__pos")


@dataclass(frozen=True)
class IqrBounds:
    bounds: dict  # column -> (low, high)


def fit_iqr(df: DataFrame, cols: list[str], factor: float = 1.5) -> IqrBounds:
    """C9 fit: [q1 - f*iqr, q3 + f*iqr] from exact, linearly interpolated quartiles
    (``ordered.column_quantiles``)."""
    qs = column_quantiles(df, cols, [0.25, 0.75])
    out = {}
    for c in cols:
        q = qs[c]
        if q is None or q[0] is None:
            out[c] = (None, None)
            continue
        iqr = q[1] - q[0]
        out[c] = (q[0] - factor * iqr, q[1] + factor * iqr)
    return IqrBounds(out)


def clip_iqr(df: DataFrame, cols: list[str], factor: float = 1.5, bounds: IqrBounds | None = None) -> DataFrame:
    """Clip to the IQR fences; NULL stays NULL."""
    b = bounds or fit_iqr(df, cols, factor)
    out = {}
    for c in cols:
        lo, hi = b.bounds[c]
        if lo is None:
            continue
        x = F.col(c)
        out[c] = F.when(x.isNull(), x).otherwise(F.least(F.greatest(x, F.lit(lo)), F.lit(hi)))
    return df.withColumns(out) if out else df


def outlier_summary(df: DataFrame, cols: list[str], factor: float = 1.5) -> DataFrame:
    """Per feature, IQR fences and the count/percentage of values outside them.

    Unpivoted so one grouped aggregate handles every feature (feature-parallel, not one job per
    feature); the fences join back on the feature name (one row per feature).
    """
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot([], cols, "feature", "value")
    q = exact_quantiles_long(long, ["feature"], "value", [0.25, 0.75]).groupBy("feature").agg(
        F.max(F.when(F.col("p") == 0.25, F.col("value"))).alias("q1"),
        F.max(F.when(F.col("p") == 0.75, F.col("value"))).alias("q3"))
    q = q.withColumns({
        "lower": F.col("q1") - factor * (F.col("q3") - F.col("q1")),
        "upper": F.col("q3") + factor * (F.col("q3") - F.col("q1")),
    })
    counted = long.join(F.broadcast(q.select("feature", "lower", "upper")), "feature").groupBy("feature").agg(
        F.count("value").alias("n"),
        F.count_if((F.col("value") < F.col("lower")) | (F.col("value") > F.col("upper"))).alias("outliers"),
    )
    return (q.join(counted, "feature")
            .select("feature",
                    F.round("lower", 6).alias("lower"), F.round("upper", 6).alias("upper"),
                    F.col("outliers").cast("bigint").alias("outliers"),
                    F.round(F.col("outliers") * 100.0 / F.col("n"), 6).alias("outlier_pct")))


def preprocess(df: DataFrame, levels: list[str] | None = None, imputation: Imputation | None = None,
               one_hot_state: bool = True, dedup: bool = True) -> DataFrame:
    """C11: dedup, impute, encode plans and label, one-hot state, drop area code (in this order).

    ``dedup=False`` when the input is already deduplicated (e.g. a checkpointed ``dedup_rows``).
    """
    out = dedup_rows(df) if dedup else df
    out = impute(out, imputation)
    out = encode_yes_no(out)
    out = encode_label(out)
    if one_hot_state:
        out = one_hot(out, "state", levels)
    return drop_if_exists(out, ["area_code"])
