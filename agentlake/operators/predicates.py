"""Filters, lookups and row rules."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from agentlake.functions.scalars import BAD_LINE, UNKNOWN_ITEM


def top_n(df: DataFrame, by: str, tie: str, n: int, ascending: bool = False) -> DataFrame:
    return df.orderBy(F.asc(by) if ascending else F.desc(by), F.asc(tie)).limit(n)


def unpack_metadata(df: DataFrame, col: str, keys: Sequence[str]) -> DataFrame:
    """Single- or double-quoted dict text to one string column per key; a missing key or bad text gives ``''``."""
    parsed = F.from_json(F.col(col), "map<string,string>", {"allowSingleQuotes": "true"})
    return df.withColumn("__m", parsed).withColumns(
        {k: F.coalesce(F.col("__m")[k], F.lit("")) for k in keys}
    ).drop("__m")


def normalize_date(c: Column) -> Column:
    """ISO date or datetime text to a date; text that is no date gives null."""
    return F.try_to_date(F.substring_index(F.substring_index(c, "T", 1), " ", 1), "yyyy-MM-dd")


def parse_us_date(df: DataFrame, col: str, out: str) -> DataFrame:
    """``MM/dd/yy`` text to a date; rows that do not parse are dropped."""
    return df.withColumn(out, F.try_to_date(F.col(col), "MM/dd/yy")).filter(F.col(out).isNotNull())


def has_all_terms(cols: Sequence[str], terms: Iterable[str]) -> Column:
    """Every non-empty term occurs, in any case, in at least one of the columns."""
    conds = [
        reduce(lambda a, b: a | b, [F.coalesce(F.contains(F.lower(c), F.lit(t.lower())), F.lit(False)) for c in cols])
        for t in terms
        if t
    ]
    return reduce(lambda a, b: a & b, conds, F.lit(True))


def search_quotes(
    quotes: DataFrame, requests: DataFrame, terms: Sequence[str], on: str, text_cols: Sequence[str],
    newest: str, limit: int = 5,
) -> DataFrame:
    """Quotes joined to their requests where all terms occur in either text, newest first, ties by id."""
    hits = quotes.join(requests, on).filter(has_all_terms(text_cols, terms))
    return hits.orderBy(F.desc(newest), F.asc(on)).limit(limit)


def lookup_ci(df: DataFrame, name: str, catalog: DataFrame, catalog_name: str, how: str = "left") -> DataFrame:
    """Case-insensitive exact lookup as an equi-join on the lower-cased name."""
    return df.join(catalog, F.lower(df[name]) == F.lower(catalog[catalog_name]), how)


def compile_where(where: Mapping | None, schema: StructType | None = None) -> Column:
    """``{k: v}``, ``$eq $ne $gt $gte $lt $lte $in $nin``, ``$and`` and ``$or`` to a Column the optimizer can push down."""
    if not where:
        return F.lit(True)
    ops = {
        "$eq": lambda c, v: c == v, "$ne": lambda c, v: c != v,
        "$gt": lambda c, v: c > v, "$gte": lambda c, v: c >= v,
        "$lt": lambda c, v: c < v, "$lte": lambda c, v: c <= v,
        "$in": lambda c, v: c.isin(list(v)), "$nin": lambda c, v: ~c.isin(list(v)),
    }
    parts = []
    for key, cond in where.items():
        if key in ("$and", "$or"):
            subs = [compile_where(s, schema) for s in cond]
            parts.append(reduce((lambda a, b: a & b) if key == "$and" else (lambda a, b: a | b), subs))
            continue
        if key.startswith("$"):
            raise ValueError(f"unknown operator {key}")
        if schema is not None and key not in schema.names:
            raise ValueError(f"unknown field {key}")
        if not isinstance(cond, Mapping):
            parts.append(F.col(key) == cond)
            continue
        for name, value in cond.items():
            if name not in ops:
                raise ValueError(f"unknown operator {name}")
            parts.append(ops[name](F.col(key), F.lit(value) if name not in ("$in", "$nin") else value))
    return reduce(lambda a, b: a & b, parts)


def compile_where_document(cond: Mapping | None, col: str = "text") -> Column:
    """``$contains``, ``$not_contains``, ``$and``, ``$or`` over the document text."""
    if not cond:
        return F.lit(True)
    parts = []
    for key, value in cond.items():
        if key == "$contains":
            parts.append(F.contains(F.col(col), F.lit(value)))
        elif key == "$not_contains":
            parts.append(~F.contains(F.col(col), F.lit(value)))
        elif key in ("$and", "$or"):
            subs = [compile_where_document(s, col) for s in value]
            parts.append(reduce((lambda a, b: a & b) if key == "$and" else (lambda a, b: a | b), subs))
        else:
            raise ValueError(f"unknown operator {key}")
    return reduce(lambda a, b: a & b, parts)


def get_documents(
    df: DataFrame, id_col: str, ids: Sequence | DataFrame | None = None, where: Mapping | None = None,
    where_document: Mapping | None = None, limit: int | None = None, text: str = "text",
) -> DataFrame:
    """Fetch by ids (a short list or a table of ids) and filters, without similarity."""
    if isinstance(ids, DataFrame):
        df = df.join(ids.select(id_col).distinct(), id_col, "left_semi")
    elif ids is not None:
        df = df.filter(F.col(id_col).isin(list(ids)))
    df = df.filter(compile_where(where, df.schema) & compile_where_document(where_document, text))
    return df if limit is None else df.orderBy(id_col).limit(limit)


def match_attributes(df: DataFrame, attributes: Mapping) -> DataFrame:
    """Equality on the attributes the table has; unknown attributes are ignored."""
    for name, value in attributes.items():
        if name in df.columns:
            df = df.filter(F.col(name) == F.lit(value))
    return df


def flag_keywords(text: Column, keywords: Sequence[str]) -> Column:
    """Keywords found in the text, in list order. The text is lower-cased once."""
    low = F.lower(text)
    return F.array_compact(F.array(*[F.when(F.contains(low, F.lit(k)), F.lit(k)) for k in keywords]))


def label_if_any(text: Column, keywords: Sequence[str], label: str, default: str) -> Column:
    return F.when(F.size(flag_keywords(text, keywords)) > 0, label).otherwise(default)


# fixed values: urgency terms, English then Chinese
URGENT_TERMS = (
    "urgent", "emergency", "immediately", "asap", "right away", "right now",
    "紧急", "急需", "立即", "马上", "立刻", "赶快", "尽快", "迫切", "急迫",
)


def urgency(text: Column) -> Column:
    return label_if_any(text, URGENT_TERMS, "urgent", "normal")


def first_match(value: Column, rules: Sequence[tuple[Sequence[str], str]], default: str | None = None) -> Column:
    """Label of the first rule one of whose members equals the value or is in the array value."""
    out = None
    for members, label in rules:
        cond = F.arrays_overlap(value, F.array(*[F.lit(m) for m in members]))
        out = F.when(cond, label) if out is None else out.when(cond, label)
    return out.otherwise(default) if default is not None else out


def validate_lines(lines: DataFrame, catalog: DataFrame, item: str = "item", quantity: str = "quantity") -> DataFrame:
    """Lines with catalog price, ``valid`` and ``reason``: bad quantity or name first, then unknown item."""
    known = catalog.select(F.col("item").alias("__c"), F.col("unit_price"))
    joined = lines.join(known, lines[item] == known["__c"], "left")
    reason = (
        F.when(F.col(item).isNull() | F.col(quantity).isNull() | (F.col(quantity) <= 0), BAD_LINE)
        .when(F.col("__c").isNull(), UNKNOWN_ITEM)
    )
    return joined.withColumn("reason", reason).withColumn("valid", F.col("reason").isNull()).drop("__c")


def clean_null_token(c: Column) -> Column:
    # fixed values: texts that stand for a missing value
    return F.when(c.isin("", "None", "null", "NULL"), None).otherwise(c)


def default_if_negative(answer: Column, markers: Sequence[str], default: Column | str) -> Column:
    """The default where the answer contains one of the negative markers (any case) or is empty."""
    low = F.lower(F.coalesce(answer, F.lit("")))
    hit = reduce(lambda a, b: a | b, [F.contains(low, F.lit(m.lower())) for m in markers])
    return F.when(hit | (F.trim(low) == ""), default if isinstance(default, Column) else F.lit(default)).otherwise(answer)


def on_calendar(
    df: DataFrame, start: str, day: str | None = None, city: str | None = None, ids: Sequence | None = None,
    id_col: str = "activity_id", valid: tuple[str, str] | None = None,
) -> DataFrame:
    """Calendar rows by city, day and ids; a day outside the valid range gives no rows; all conditions are optional."""
    if city is not None:
        df = df.filter(F.col("city") == city)
    if ids is not None:
        df = df.filter(F.col(id_col).isin(list(ids)))
    if day is not None:
        d = F.lit(day).cast("date")
        df = df.filter(F.col(start).cast("date") == d)
        if valid is not None:
            df = df.filter(d.between(F.lit(valid[0]).cast("date"), F.lit(valid[1]).cast("date")))
    return df


def lookup_default(df: DataFrame, dim: DataFrame, on: str, defaults: Mapping) -> DataFrame:
    """Left join to a dimension; columns of unmatched rows take the given defaults."""
    out = df.join(dim, on, "left")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def allowed_label(answer: Column, allowed: Sequence[str], default: str) -> Column:
    """Trimmed lower-case answer when it is one of the allowed labels, else the default."""
    clean = F.lower(F.trim(answer))
    return F.when(clean.isin(list(allowed)), clean).otherwise(default)


def fan_out(df: DataFrame, members: Sequence[str], name: str = "expert") -> DataFrame:
    """One copy of every row per member of a fixed set, made in the row itself."""
    return df.withColumn(name, F.explode(F.array(*[F.lit(m) for m in members])))


def route_exact(df: DataFrame, key: str, handlers: Mapping[str, str]) -> DataFrame:
    """Handler of an exact key; other rows get an error text."""
    out = None
    for k, v in handlers.items():
        out = F.when(F.col(key) == k, v) if out is None else out.when(F.col(key) == k, v)
    return df.withColumn("handler", out).withColumn(
        "error", F.when(F.col("handler").isNull(), F.concat(F.lit("no handler for "), F.coalesce(F.col(key).cast("string"), F.lit("null"))))
    )


def match_substring(
    df: DataFrame, name: str, profiles: DataFrame, profile_name: str, order: str, value: str, default: str, gram: int = 3
) -> DataFrame:
    """Value of the first profile (by ``order``) whose name contains the row's name, in any case; else the default.

    Each distinct name is looked up once, and containment becomes an equi-join on grams of the profiles' names. What a name
    of at most ``gram`` characters asks for is known per gram before any join: the first profile that holds it. A longer name
    asks with the one of its grams that the fewest profiles hold, and its candidates are verified. Profiles without an order
    are never first; of profiles with one order the smaller value is taken.
    """
    asked = df.select(F.lower(name).alias("__asked")).filter(F.length("__asked") > 0).distinct()
    place = F.struct(F.col(order).alias("__order"), F.col(value).alias("__value"))
    held = profiles.filter(F.col(order).isNotNull()).groupBy(F.lower(profile_name).alias("__low")).agg(F.min(place).alias("__place"))
    starts = F.sequence(F.lit(1), F.greatest(F.length("__low"), F.lit(1)))
    cuts = lambda sizes: F.array_distinct(F.flatten(F.transform(
        starts, lambda i: F.transform(sizes, lambda n: F.substr(F.col("__low"), i, n))
    )))
    offers = held.select("__low", "__place", F.explode(cuts(F.sequence(F.lit(1), F.lit(gram)))).alias("__gram"))
    # summed before the shuffle, so a gram that nearly every profile holds is a few rows
    known = offers.groupBy("__gram").agg(F.min("__place").alias("__place"), F.count("*").alias("__n"))
    short = asked.filter(F.length("__asked") <= gram).join(known, F.col("__asked") == F.col("__gram")).select("__asked", "__place")
    inner = F.sequence(F.lit(1), F.length("__asked") - (gram - 1))
    pieces = F.array_distinct(F.transform(inner, lambda i: F.substr(F.col("__asked"), i, F.lit(gram))))
    asks = asked.filter(F.length("__asked") > gram).select("__asked", F.explode(pieces).alias("__gram"))
    asks = asks.join(known.select("__gram", "__n"), "__gram", "left")
    rarest = asks.groupBy("__asked").agg(F.min(F.struct(F.coalesce("__n", F.lit(0)).alias("n"), F.col("__gram"))).alias("__rare"))
    whole = offers.filter(F.length("__gram") == gram)
    hits = rarest.select("__asked", F.col("__rare.__gram").alias("__gram")).join(whole, "__gram").filter(F.contains("__low", "__asked"))
    found = short.unionByName(hits.select("__asked", "__place"))
    first = found.groupBy("__asked").agg(F.min("__place").alias("__p")).select("__asked", F.col("__p.__value").alias("__v"))
    out = df.join(first, F.lower(df[name]) == first["__asked"], "left")
    return out.withColumn(value, F.coalesce("__v", F.lit(default))).drop("__v", "__asked")
