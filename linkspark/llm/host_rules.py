"""Quality rules with verdicts on hosts: failures summed by host, rates shrunk by an empirical beta prior."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE, stash, words

WHITE = " \t\n\x0b\x0c\r"


def repeat_words(w) -> F.Column:
    """Words that lie in a 3-word window found twice or more; ``w`` is a column of words.

    Windows are told apart by a 64-bit hash. A text in which all windows differ, as
    most do, ends at the count of distinct hashes; else windows are sorted by hash,
    neighbours with equal hashes kept, and the words that they cover counted in order.
    """
    windows = F.transform(F.sequence(F.lit(1), F.size(w) - 2), lambda i: F.xxhash64(F.get(w, i - 1), F.get(w, i), F.get(w, i + 1)))

    def covered(h):
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        found = F.transform(
            F.array(ordered),
            lambda s: F.sort_array(
                F.transform(
                    F.filter(s, lambda x, i: (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"])),
                    lambda x: x["i"],
                )
            ),
        )[0]
        start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n"))
        step = lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(3), i - a["last"])).alias("n"))
        return F.aggregate(found, start, step, lambda a: a["n"])

    def of(h):
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(covered(h))

    return F.when(F.size(w) < 4, F.lit(0).cast("long")).otherwise(F.transform(F.array(windows), of)[0])


def measure(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` and n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each whole text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    slim = docs.select(*keep, text.alias("_text"))
    lines = F.filter(F.split("_text", "\n"), lambda x: F.length(F.translate(x, WHITE, "")) > 0)
    of_words = F.transform(
        F.array(words(F.col("_text"))),
        lambda w: F.struct(F.size(w).cast("long").alias("n"), repeat_words(w).alias("r")),
    )[0]
    of_lines = F.transform(F.array(lines), lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))[0]
    return slim.select(
        *keep,
        of_words.alias("_w"),
        F.length(F.translate("_text", WHITE, "")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.translate("_text", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        of_lines.alias("n_dup_lines"),
    ).select(*keep, F.col("_w.n").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines", F.col("_w.r").alias("n_repeat_words"))


def host_verdicts(facts: DataFrame, limit: float = 0.5, times: float = 2.0, deviations: float = 4.0) -> DataFrame:
    """One row a host of ``facts(host, failed)``: host, host_docs, host_failed, host_rate, host_ok.

    The rates' mean m and variance v over hosts give the beta prior by moments, with
    strength s = m(1 - m)/v - 1, at least 1 and at most a million (v is 0 where hosts
    agree or only one exists). host_rate = (failed + s m)/(docs + s). A host is bad if
    that is over ``limit``, or stands out of the prior: over ``times`` its mean and over
    ``deviations`` of its standard deviations above it. A null host is a host of its own.
    """
    hosts = facts.groupBy("host").agg(F.count("*").alias("host_docs"), F.sum(F.col("failed").cast("long")).alias("host_failed"))
    rate = F.col("host_failed") / F.col("host_docs")
    prior = hosts.agg(F.avg(rate).alias("m"), F.var_pop(rate).alias("v"))
    strength = F.least(F.lit(1e6), F.greatest(F.lit(1.0), F.coalesce(F.try_divide(F.col("m") * (1 - F.col("m")), F.col("v")) - 1, F.lit(1e6))))
    usual = F.greatest(times * F.col("m"), F.col("m") + deviations * F.sqrt("v"))
    prior = prior.select("m", strength.alias("s"), F.least(F.lit(limit), F.coalesce(usual, F.lit(limit))).alias("most"))
    # the prior is one row
    shrunk = hosts.join(F.broadcast(prior), F.lit(True)).withColumn("host_rate", (F.col("host_failed") + F.col("s") * F.col("m")) / (F.col("host_docs") + F.col("s")))
    return shrunk.select("host", "host_docs", "host_failed", "host_rate", (F.col("host_rate") <= F.col("most")).alias("host_ok"))


def judge(docs: DataFrame, host: str = "source", least_words: int = 50, repeat_percent: int = 50, limit: float = 0.5) -> DataFrame:
    """Verdicts on ``docs(doc_id, text, <host>)``: doc_id, host, five measures, base_failed, host_rate, kept.

    A document fails with fewer than ``least_words`` words, or if over
    ``repeat_percent`` percent of its words lie in repeated 3-word windows. The
    failures of a host, which is what the column ``host`` says (a domain, or a source where
    documents have no domain), decide on all its documents (see host_verdicts). The measures
    are written to the shared folder once; hosts are summed before they are shuffled,
    and the join back is one that Spark splits where a host is hot.

    A null or empty text has no words and fails. A null host is a host. Repeated rows
    are judged row by row, a null doc_id as any other. An empty table gives no rows.
    Other columns are ignored.
    """
    facts = measure(docs.select("doc_id", F.col(host).cast("string").alias("host"), "text"), ["doc_id", "host"])
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))
    facts = stash(facts.withColumn("base_failed", failed), "host-rules")
    verdicts = host_verdicts(facts.select("host", F.col("base_failed").alias("failed")), limit)
    verdicts = verdicts.select(F.col("host").alias("_host"), "host_rate", "host_ok")
    joined = facts.join(verdicts, F.col("host").eqNullSafe(F.col("_host")), "left")
    return joined.select("doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "host_rate", (~F.col("base_failed") & F.col("host_ok")).alias("kept"))


def keep_good(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` that judge() keeps, with their columns; rows are told apart by their place, not by doc_id.

    Base rules are evaluated row by row, host verdicts joined on the host.
    """
    host, limit = settings.get("host", "source"), settings.get("limit", 0.5)
    kept_cols = docs.columns
    facts = measure(docs.select(F.struct(*kept_cols).alias("_row"), F.col(host).cast("string").alias("_host"), "text"), ["_row", "_host"])
    failed = (F.col("n_words") < settings.get("least_words", 50)) | (100 * F.col("n_repeat_words") > settings.get("repeat_percent", 50) * F.col("n_words"))
    facts = stash(facts.select("_row", "_host", failed.alias("_failed")), "host-rules")
    verdicts = host_verdicts(facts.select(F.col("_host").alias("host"), F.col("_failed").alias("failed")), limit).select("host", "host_ok")
    # written, so that their size is known when the join is planned
    verdicts = stash(verdicts, "host-verdicts")
    good = facts.filter(~F.col("_failed")).join(verdicts, F.col("_host").eqNullSafe(F.col("host")), "left").filter("host_ok")
    return good.select(*[F.col("_row")[c].alias(c) for c in kept_cols])
