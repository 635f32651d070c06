"""URLs judged by rules and, where none fits, by the ratio of two character models.

URLs that an allow or a block rule decides are the examples. Two Markov models of variable
order, one of each kind, give the probability of a character after the four before it. What
an order has not seen is left to the next shorter one (Witten-Bell: as much weight as the
context has had different followers), and at last to an even chance. The score of a URL is
the difference of the models' log-likelihoods, divided by its length. A fifth of the examples
is kept out of the models and serves to set the score from which URLs are allowed.

All steps are DataFrame operations. Models are tables keyed by a piece of ORDER + 1
characters; they hold only pieces that occur and are joined, never collected. Joins are hinted
to merge: Spark takes the size of a side from files, which are far smaller than what they are
turned into (pieces of URLs, copies of a model), and would send that through the driver.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from downfold.llm.common import folded, written

#: Characters that a model looks back.
ORDER = 4
#: Before a URL, as often as the order; after it, once.
BEGIN, END = "\u0002", "\u0003"
#: The last resort: an even chance among so many characters.
EVEN = 256
#: Log ratios are summed as whole numbers of 2^-20, so sums do not depend on the order of rows.
UNIT = 1 << 20
#: One of so many parts of the examples calibrates; scores count in bins of 1 / BINS nat a character.
PARTS, BINS, FARTHEST = 5, 100, 2000
#: Copies of a model that share the occurrences of each piece between them.
COPIES = 16


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    return folded(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest of ``rules`` that fits, or nulls.

    A rule is (verdict, host and path), such as ("block", "net/es/"). It fits its host and all
    subdomains if the path starts with the rule's. Rules are compared one after another.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def _pieces(rows: DataFrame, *keep: str) -> DataFrame:
    """``keep`` and ``piece`` for each character of a URL and its end: with the ORDER characters before.

    A digit reads as 0: numbers name pages, not kinds of pages.
    """
    plain = F.translate(F.coalesce("url", F.lit("")), "123456789", "000000000")
    signs = F.split(F.concat(F.lit(BEGIN * ORDER), plain, F.lit(END)), "")
    rows = rows.select(*keep, signs.alias("signs"))
    starts = F.sequence(F.lit(1), F.size("signs") - ORDER)
    pieces = F.transform(starts, lambda i: F.array_join(F.slice("signs", i, ORDER + 1), ""))
    return rows.select(*keep, F.explode(pieces).alias("piece"))


def log_ratios(counts: DataFrame) -> DataFrame:
    """(piece, ratio) from ``counts`` (piece, a, b), the occurrences of pieces in either kind.

    ratio is log p_a - log p_b of the last character after those before it, in whole UNITs.
    Pieces without an occurrence get what shorter contexts say.
    """
    levels = [counts]
    for _ in range(ORDER):
        shorter = levels[-1].groupBy(F.expr("substring(piece, 2)").alias("piece"))
        levels.append(shorter.agg(F.sum("a").alias("a"), F.sum("b").alias("b")))
    known = None
    for order, level in enumerate(reversed(levels)):
        same = Window.partitionBy(F.expr(f"left(piece, {order})"))
        level = level.select(
            "piece", "a", "b", *[f(c).over(same).alias(f"{n}_{c}") for c in "ab" for n, f in (("all", F.sum), ("kinds", _kinds))]
        )
        if known is None:
            level = level.withColumns({"less_a": F.lit(1.0 / EVEN), "less_b": F.lit(1.0 / EVEN)})
        else:
            known = known.withColumnRenamed("piece", "end").hint("merge")
            level = level.join(known, F.expr("substring(piece, 2)") == F.col("end"))
        known = level.select("piece", *[_smoothed(c).alias(f"less_{c}") for c in "ab"])
    ratio = (F.log("less_a") - F.log("less_b")) * UNIT
    return known.select("piece", F.floor(ratio + 0.5).cast("long").alias("ratio"))


def _kinds(name: str) -> Column:
    return F.sum((F.col(name) > 0).cast("long"))


def _smoothed(c: str) -> Column:
    seen, kinds, less = F.col(f"all_{c}"), F.col(f"kinds_{c}"), F.col(f"less_{c}")
    return F.when(seen > 0, (F.col(c) + kinds * less) / (seen + kinds)).otherwise(less)


def _scored(rows: DataFrame, ratios: DataFrame) -> DataFrame:
    """(row, bin, score) of ``rows``. A piece that very many URLs hold is spread over COPIES keys."""
    copies = ratios.select("piece", "ratio", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))).alias("copy"))
    # a random number, not a hash of the row: one long URL may repeat a piece many times, and sums do not depend on it
    pieces = _pieces(rows, "row").withColumn("copy", F.floor(F.rand(7) * COPIES).cast("int"))
    scored = pieces.join(copies.hint("merge"), ["piece", "copy"])
    sums = scored.groupBy("row").agg(F.sum("ratio").alias("total"), F.count("*").alias("n"))
    binned = F.floor(F.col("total") * float(BINS) / (F.col("n") * float(UNIT)))
    binned = F.greatest(F.lit(-FARTHEST), F.least(F.lit(FARTHEST), binned)).cast("int")
    return sums.select("row", binned.alias("bin"), (F.col("total") / (F.col("n") * float(UNIT))).alias("score"))


def least_allowed(examples: DataFrame) -> int:
    """The bin from which to allow: most right verdicts on ``examples`` (bin, verdict), either kind counting as one half.

    Of equally good bins with examples that nearest to 0, then the lower; the least score
    allowed is half way down from there to the next bin with examples. It is 0 without
    examples of both kinds. The table of bins has 2 * FARTHEST + 1 rows at most.
    """
    either = [F.count_if(F.col("verdict") == kind).alias(name) for kind, name in (("allow", "a"), ("block", "b"))]
    bins = examples.groupBy("bin").agg(*either)
    before = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    all_rows = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    lost = F.coalesce(F.sum("a").over(before), F.lit(0))
    caught = F.coalesce(F.sum("b").over(before), F.lit(0))
    all_a, all_b = F.sum("a").over(all_rows), F.sum("b").over(all_rows)
    half = F.expr("(bin - coalesce(below, bin)) div 2")
    ranked = bins.withColumn("below", F.lag("bin").over(Window.orderBy("bin")))
    ranked = ranked.select("bin", (F.col("bin") - half).alias("least"), ((all_a - lost) * all_b + caught * all_a).alias("right"), (all_a * all_b).alias("both"))
    best = ranked.filter(F.col("both") > 0).orderBy(F.desc("right"), F.abs("bin"), "bin").first()
    return best["least"] if best else 0


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]], url: str = "url", key: str = "page_id") -> DataFrame:
    """(``key``, url, host, path, rule, score, verdict) for every row of ``pages``.

    verdict is the longest fitting rule's, or else allow if the calibrated models prefer it
    and block if not. score (in nats a character, higher: more like what is allowed) is null
    where a rule decides, but for the examples that calibrate.

    A null URL is an empty one, with host and path empty; empty URLs are judged by their end
    alone. Repeated rows and rows with a null key are each judged, and count as often as
    examples. Other columns, whatever their names, are left out. Without examples of both
    kinds the least score allowed is 0; without any, every score is 0 and all is allowed. An
    empty table gives an empty result. A long URL is one row until it is in pieces; these
    are spread over tasks. Nothing is broadcast.
    """
    rows = pages.select(F.col(key).alias(key), F.col(url).cast("string").alias("url"))
    rows = rows.select(key, "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rule, ruled = rule_for(F.col("host"), F.col("path"), rules)
    part = F.conv(F.substring(F.md5(F.coalesce("url", F.lit("")).cast("binary")), 1, 8), 16, 10).cast("long") % PARTS
    rows = rows.select(
        "*", rule.alias("rule"), ruled.alias("ruled"), (part == 0).alias("held"), F.monotonically_increasing_id().alias("row")
    )
    rows = written(rows, "urls")  # numbers of rows stay as they are from here on
    learned = [
        ((F.col("ruled") == kind) & ~F.col("held")).alias(name) for kind, name in (("allow", "a"), ("block", "b"))
    ]
    pieces = _pieces(rows.select("url", *learned), "a", "b").groupBy("piece")
    counts = written(pieces.agg(F.count_if("a").alias("a"), F.count_if("b").alias("b")), "pieces")
    open_rows = rows.filter(F.col("ruled").isNull() | F.col("held"))
    scores = written(_scored(open_rows, log_ratios(counts)), "scores").hint("merge")
    held = rows.filter(F.col("ruled").isNotNull() & F.col("held")).select("row", F.col("ruled").alias("verdict"))
    least = least_allowed(held.join(scores, "row").select("bin", "verdict"))
    verdict = F.coalesce("ruled", F.when(F.col("bin") >= least, "allow").otherwise("block"))
    return rows.join(scores, "row", "left").select(key, "url", "host", "path", "rule", "score", verdict.alias("verdict"))
