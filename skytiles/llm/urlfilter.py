"""URL filters: rules, and a character language-model ratio for the rest.

Rules name a host (with all its subdomains) and a path prefix; the longest
fitting rule decides. Addresses that no rule fits are judged by two
smoothed variable-order Markov models, one of accepted and one of rejected
addresses, learned from the addresses that rules decide. With ``c(s)`` the
number of times a string ``s`` was met, a character ``x`` after the
context ``s`` has

    p_n(x | s) = (c(s x) + STRENGTH * p_(n-1)(x | s without its first character))
                 / (c(s) + STRENGTH),         p_(-1) = 1 / ALPHABET

up to ``ORDER`` characters of context; the sum of log p_accepted - log
p_rejected over all characters, divided by their number, is compared with
a threshold that separates held-out rule-decided addresses best.

A place's step reads nothing but the ``ORDER + 1`` characters that end
there, its window. So windows are counted (a partial aggregate), the counts
of all shorter strings are sums over distinct windows, and a step is worked
out once per distinct window. Counts are exact and kept as a table, a row a
string, which grows with the input; it is joined, never collected.
Everything is DataFrame expressions.

Defined cases: a null address, or one without ``://``, has an empty host
and path and no rule; a null or empty address is judged by its end mark
alone; without held-out addresses of both kinds every verdict of the method
is allow; repeated rows are each judged and each
counted; a very long address has a window at every place, like others; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import write_scratch_table

# --- Fixed values: the rules as (verdict, host, path prefix).
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"),
         ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"),
         ("block", "com", "/de/"))

ORDER = 4                # characters of context
STRENGTH = 2.0
ALPHABET = 128
HOLDOUT = 5              # one address in so many calibrates instead of training
BINS = 400               # of the calibration histogram, over the range of the ratios
START, END = "\u0002", "\u0003"
UNIT = 1 << 36           # steps are summed as whole multiples of 1 / UNIT


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of an address."""
    safe = F.coalesce(url, F.lit(""))
    at = F.instr(safe, "://")
    rest = F.when(at > 0, F.substr(safe, at + 3, F.length(safe))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1, F.length(rest) + 1), r"^[^?#]*", 0)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), path


def fitting_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as ``host + path``, and its verdict."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = (((host == rule_host) | host.endswith("." + rule_host))
                & path.startswith(rule_path))
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


def _framed(url: Column) -> Column:
    return F.concat(F.lit(START * ORDER), F.coalesce(url, F.lit("")), F.lit(END))


def _windows() -> Column:
    """The ``ORDER + 1`` characters that end at each place of an address."""
    return F.explode(F.transform(
        F.sequence(F.lit(ORDER + 1), F.length("framed")),
        lambda at: F.substr("framed", at - ORDER, F.lit(ORDER + 1)))).alias("window")


def _strings(first: int = 0) -> Column:
    """The strings of a window, a row each from kind ``first`` on: of order
    n the context (kind 2n) and the context with its character (2n + 1)."""
    text = F.col("window")
    kinds = [(2 * n + side, F.substr(text, F.lit(ORDER + 1 - n), F.lit(n + side)))
             for n in range(ORDER + 1) for side in (0, 1)]
    return F.inline(F.array(*[F.struct(F.lit(k).alias("kind"), s.alias("s"))
                              for k, s in kinds if k >= first]))


def string_counts(labelled: DataFrame) -> DataFrame:
    """``kind, s, a, r``: how often each string was met in accepted and in
    rejected addresses. ``labelled`` has ``framed`` texts and ``accepted``."""
    windows = labelled.select("accepted", _windows()).groupBy("window").agg(
        F.count_if("accepted").alias("a"), F.count_if(~F.col("accepted")).alias("r"))
    return (windows.select("a", "r", _strings()).groupBy("kind", "s")
            .agg(F.sum("a").alias("a"), F.sum("r").alias("r")))


def window_steps(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """``window, step`` for distinct windows: log p_accepted - log
    p_rejected of the last character, in ``1 / UNIT``."""
    # The empty context is in every window: it is no join key.
    whole = counts.where("kind = 0")
    found = (windows.select("window", _strings(1))
             .join(counts.where("kind > 0"), ["kind", "s"], "left").groupBy("window")
             .agg(*[F.sum(F.when(F.col("kind") == k, F.col(side))).alias(f"{side}{k}")
                    for k in range(1, 2 * ORDER + 2) for side in "ar"])
             .withColumns({f"{side}0": whole.agg(F.sum(side)).scalar() for side in "ar"}))

    def log_p(side) -> Column:
        p = F.lit(1.0 / ALPHABET)
        for n in range(ORDER + 1):
            context, text = (F.coalesce(F.col(f"{side}{k}"), F.lit(0))
                             for k in (2 * n, 2 * n + 1))
            p = (text + STRENGTH * p) / (context + STRENGTH)
        return F.log(p)

    return found.select("window", F.round((log_p("a") - log_p("r")) * UNIT)
                        .cast("long").alias("step"))


def with_ratio(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """``ratio`` added: the length-normalised log-likelihood difference.

    Rows are stored with a number; windows meet their steps with that
    number alone. Steps are whole numbers, so their sum does not depend on
    the order in which they arrive."""
    numbered = write_scratch_table(
        rows.withColumn("row", F.monotonically_increasing_id()), "url-rows")
    places = numbered.select("row", _windows())
    steps = window_steps(places.select("window").distinct(), counts)
    sums = places.join(steps, "window").groupBy("row").agg(F.sum("step").alias("step"))
    return (numbered.join(sums, "row")
            .withColumn("ratio", F.col("step") / (F.length("framed") - ORDER) / UNIT)
            .drop("row", "step"))


def threshold(scored: DataFrame) -> float:
    """The ratio that separates ``accepted`` from rejected rows best (the
    share of accepted rows kept plus that of rejected rows dropped is
    largest), from a histogram of ``BINS`` steps between the least and the
    largest ratio; without both kinds minus infinity, which allows all."""
    ends = scored.agg(F.min("ratio").alias("low"), F.max("ratio").alias("high")).first()
    if ends["low"] is None:
        return float("-inf")
    low, step = ends["low"], (ends["high"] - ends["low"]) / BINS or 1.0
    bin_ = F.least(F.floor((F.col("ratio") - low) / step), F.lit(BINS - 1))
    rows = (scored.groupBy(bin_.alias("bin"))
            .agg(F.count_if("accepted").alias("a"), F.count_if(~F.col("accepted")).alias("r"))
            .collect())                                # BINS rows at most
    good = {r["bin"]: r["a"] for r in rows}
    bad = {r["bin"]: r["r"] for r in rows}
    all_good, all_bad = sum(good.values()), sum(bad.values())
    if not all_good or not all_bad:
        return float("-inf")
    best, at, below_good, below_bad = -1.0, 0, 0, 0
    for cut in range(BINS + 1):
        gain = (all_good - below_good) / all_good + below_bad / all_bad
        # Of equal cuts the one nearest to no difference.
        if gain > best + 1e-12 or (gain > best - 1e-12
                                   and abs(low + cut * step) < abs(low + at * step)):
            best, at = gain, cut
        below_good += good.get(cut, 0)
        below_bad += bad.get(cut, 0)
    return low + at * step


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
               rules=RULES) -> DataFrame:
    """One row per page: ``id_col, host, path, rule, ratio, verdict``."""
    host, path = split_url(F.col(url_col))
    name, decided = fitting_rule(F.col("host"), F.col("path"), rules)
    rows = (pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"),
                         host.alias("host"), path.alias("path"))
            .withColumn("rule", name).withColumn("by_rule", decided)
            .withColumn("framed", _framed(F.col("url"))))
    held = F.pmod(F.xxhash64("framed"), F.lit(HOLDOUT)) == 0
    accepted = (F.col("by_rule") == "allow").alias("accepted")
    known = rows.where("by_rule is not null")
    counts = write_scratch_table(
        string_counts(known.where(~held).select("framed", accepted)), "url-counts")
    scored = write_scratch_table(with_ratio(rows, counts), "url-ratios")
    cut = threshold(scored.where("by_rule is not null").where(held).select("ratio", accepted))
    return scored.select(
        F.col("id").alias(id_col), "host", "path", "rule", "ratio",
        F.coalesce("by_rule", F.when(F.col("ratio") >= cut, "allow")
                   .otherwise("block")).alias("verdict"))
