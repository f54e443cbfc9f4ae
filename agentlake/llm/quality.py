"""Quality rules with host verdicts, all in DataFrame operations.

Rules are judged per document; failures of every rule are summed per host, the rate of each host is shrunk towards the
common one by a beta prior that is fitted to all hosts by moments, and the host's verdict comes back to its documents. A host
where a rule fails more often than not is refused whole. Of the weaker rules (marks, repeated lines, length of words) one
failure proves little about a document; it counts where its host is suspect by that rule. Texts are read once: what the
rules need of them is a row of numbers, written to the shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agentlake.core import stable
from agentlake.llm.rows import texts

#: White space that parts words, and the marks that count as symbols. Fixed values.
SPACES = (" ", "\t", "\n", "\x0b", "\x0c", "\r")
SYMBOLS = ("#", "*", "$", "%", "&", "|", "<", ">")

#: Fewer words fail; a larger percentage of repeated words fails; words of a repeated window.
LEAST_WORDS, MOST_REPEATED, WINDOW = 10, 20, 5

#: A host is refused when its shrunk failure rate of any rule is above the first; above the second, its documents that fail a
#: weaker rule are.
REFUSED_RATE, SUSPECT_RATE = 0.6, 0.3

#: Weaker rules: more marks than words is markup or a table; over 30 % of the lines repeat earlier ones; words of fewer than 2
#: code points on average are letters set apart, of more than 100 encoded data.
MOST_DUP_LINES, SHORT_WORDS, LONG_WORDS = 30, 2, 100


def _without(text: Column, marks: tuple[str, ...]) -> Column:
    for m in marks:
        text = F.replace(text, F.lit(m))
    return text


def _windows(words: Column, make) -> Column:
    """``make(position)`` for every window of words; no windows where there are too few words."""
    at = F.when(F.size(words) >= WINDOW, F.sequence(F.lit(1), F.size(words) - (WINDOW - 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(at, make)


def weaker_rules() -> dict[str, Column]:
    """Failures of the weaker rules by name, from the columns of ``rule_counts`` and ``n_lines``."""
    n, chars = F.col("n_words"), F.col("word_chars")
    return {
        "symbols": F.col("n_symbols") > n,
        "lines": 100 * F.col("n_dup_lines") > MOST_DUP_LINES * F.col("n_lines"),
        "length": (chars < SHORT_WORDS * n) | (chars > LONG_WORDS * n),
    }


def rule_counts(docs: DataFrame, *keep: str, text: str = "text", lines: bool = False) -> DataFrame:
    """``keep`` with ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed`` of every row; no shuffle.

    Null texts are empty ones and have no word. With ``lines`` there is ``n_lines`` too, the number of lines with a word.
    """
    t = texts(docs, *keep, text=text)
    trimmed = F.btrim("text", F.lit("".join(SPACES)))
    parted = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[\\x20\\x09-\\x0D]+"))
    t = t.withColumn("words", parted)
    with_words = F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit("".join(SPACES))) != "")
    t = t.select(
        *keep, "words", F.size("words").cast("long").alias("n_words"),
        F.length(_without(F.col("text"), SPACES)).cast("long").alias("word_chars"),
        (F.length("text") - F.length(_without(F.col("text"), SYMBOLS))).cast("long").alias("n_symbols"),
        with_words.alias("lines"),
        _windows(F.col("words"), lambda i: F.xxhash64(F.slice("words", i, WINDOW))).alias("hashes"),
    )
    # texts without equal hashes have no equal windows; only the others compare the windows' words
    pairs = F.array_sort(_windows(F.col("words"), lambda i: F.struct(F.array_join(F.slice("words", i, WINDOW), " ").alias("w"), i.alias("at"))))
    t = t.withColumn("sorted", F.when(F.size(F.array_distinct("hashes")) < F.size("hashes"), pairs))
    same = F.zip_with(
        F.slice("sorted", 1, F.size("sorted") - 1), F.slice("sorted", 2, F.size("sorted") - 1),
        lambda a, b: F.when(a["w"] == b["w"], F.array(a["at"], b["at"])),
    )
    starts = F.array_sort(F.array_distinct(F.flatten(F.array_compact(same))))
    t = t.withColumn("starts", F.when(F.col("sorted").isNotNull(), starts))
    # words covered by windows that begin at the starts: the last one covers all its words, the others those before the next
    covered = F.aggregate(
        F.zip_with(F.slice("starts", 1, F.size("starts") - 1), F.slice("starts", 2, F.size("starts") - 1), lambda a, b: F.least(b - a, F.lit(WINDOW))),
        F.lit(WINDOW).cast("long"), lambda acc, x: acc + x,
    )
    t = t.select(
        *keep, "n_words", "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("starts") > 0, covered).otherwise(F.lit(0).cast("long")).alias("n_repeat_words"),
        *([F.size("lines").cast("long").alias("n_lines")] if lines else []),
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return t.withColumn("base_failed", failed)


def host_rates(counts: DataFrame, host: str, rules: Mapping[str, Column] | None = None) -> DataFrame:
    """``host, n_docs, n_failed, shrunk_rate`` per host; documents without a host are in none.

    ``n_failed`` and ``shrunk_rate`` are of the base rules; every further rule adds ``n_<rule>`` and ``<rule>_rate``. The prior
    of a rule has the mean of all documents; its weight follows from the spread of the hosts' rates beyond what chance gives.
    Where the hosts do not differ, or there are too few of them, the prior weighs as much as a host of mean size.
    """
    rules = {"failed": F.col("base_failed"), **(rules or {})}
    per = counts.where(F.col(host).isNotNull()).groupBy(host).agg(
        F.count(F.lit(1)).alias("n_docs"), *[F.sum(failed.cast("long")).alias(f"n_{r}") for r, failed in rules.items()]
    )
    per = stable(per)
    sums = [F.count(F.lit(1)).alias("hosts"), F.avg("n_docs").alias("size"), F.avg(1 / F.col("n_docs")).alias("inverse")]
    for r in rules:
        sums += [(F.sum(f"n_{r}") / F.sum("n_docs")).alias(f"m_{r}"), F.var_samp(F.col(f"n_{r}") / F.col("n_docs")).alias(f"v_{r}")]
    all_hosts = per.agg(*sums)
    priors = []
    for r in rules:
        chance = F.col(f"m_{r}") * (1 - F.col(f"m_{r}"))
        beyond = F.col(f"v_{r}") - chance * F.col("inverse")
        weight = F.when((F.col("hosts") > 2) & (beyond > 0), chance / beyond - 1)
        priors += [F.col(f"m_{r}"), F.when(weight > 0, weight).otherwise(F.col("size")).alias(f"w_{r}")]
    p = all_hosts.select(F.struct(*priors).alias("p")).scalar()
    shrunk = lambda r: (F.col(f"n_{r}") + p[f"m_{r}"] * p[f"w_{r}"]) / (F.col("n_docs") + p[f"w_{r}"])
    name = lambda r: "shrunk_rate" if r == "failed" else f"{r}_rate"
    return per.select(host, "n_docs", *[c for r in rules for c in (f"n_{r}", shrunk(r).alias(name(r)))])


def judge(
    docs: DataFrame, *keep: str, host: str = "source", text: str = "text", refused_rate: float = REFUSED_RATE,
    suspect_rate: float = SUSPECT_RATE,
) -> DataFrame:
    """Rule counts, ``base_failed``, the host's ``shrunk_rate`` and ``kept`` of every row.

    A document is kept unless it fails a base rule, its host is refused, or it fails a weaker rule by which its host is
    suspect. Null hosts refuse nothing. Repeated rows are judged and counted each; an empty table gives an empty one; columns
    beside ``keep``, ``host`` and ``text`` do not matter.
    """
    held = docs.select(*keep, F.col(host).alias("_host"), F.col(text).alias("text"))
    counts = stable(rule_counts(held, *keep, "_host", lines=True))
    weaker = weaker_rules()
    rates = host_rates(counts, "_host", weaker)
    rated = [F.col("shrunk_rate"), *[F.col(f"{r}_rate") for r in weaker]]
    rates = rates.select(
        F.col("_host").alias("_h"), "shrunk_rate", (F.greatest(*rated) > refused_rate).alias("_refused"),
        *[(F.col(f"{r}_rate") > suspect_rate).alias(f"_suspect_{r}") for r in weaker],
    )
    out = counts.join(rates, F.col("_host") == F.col("_h"), "left")
    bad = F.col("base_failed") | F.coalesce("_refused", F.lit(False))
    for r, failed in weaker.items():
        bad = bad | (failed & F.coalesce(f"_suspect_{r}", F.lit(False)))
    return out.withColumn("kept", ~bad).drop("_host", "_h", "n_lines", "_refused", *[f"_suspect_{r}" for r in weaker])
