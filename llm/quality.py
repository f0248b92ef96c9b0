"""Host-level quality rules, in DataFrame functions only.

Every document is measured by simple rules. Failures are summed by host, each host's failure rate is
shrunk towards an empirical beta prior fitted to all hosts by its moments, and the host's verdict is joined
back to its documents: on a *suspect* host the soft rules decide as well, on a *blocked* host no document stays.

Edge cases: a null text is an empty one (it fails the word minimum); a null host has no verdict and its documents
stand on their own rules; repeated rows count as often as they occur; an empty table gives an empty result; columns
of the input that share a name with a measure are left out of the measures and never read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import free_name, materialize, whole_text

SPACE = r"[\x20\x09-\x0D]+"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rules:
    min_words: int = 50
    max_repeat_share: float = 0.5
    #: Soft rules: they count for the host, and decide only on a suspect host.
    max_symbol_share: float = 0.1
    max_dup_line_share: float = 0.3
    word_length: tuple[float, float] = (2.0, 14.0)
    suspect_rate: float = 0.5
    blocked_rate: float = 0.95


def measure(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns ``keep`` and the five measures of every row, without a shuffle.

    Repeated words: positions covered by a three-word window that occurs at least twice. Windows are compared by a
    64-bit hash: they are sorted with their place, equal neighbors are repeated, and a fold adds up what they cover.
    """
    body, words, windows = "__body", "__words", "__windows"
    df = docs.select(*keep, whole_text(text).alias(body))
    df = df.withColumn(words, F.array_remove(F.split(F.col(body), SPACE), ""))
    word, n = F.col(words), F.size(words)
    triple = lambda x, i: F.struct(F.xxhash64(x, F.get(word, i + 1), F.get(word, i + 2)).alias("h"), i.alias("at"))
    lines = F.filter(F.split(F.col(body), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = df.select(
        *keep, n.cast("long").alias("n_words"), F.length(F.array_join(word, "")).cast("long").alias("word_chars"),
        F.regexp_count(F.col(body), F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"), lines.alias("__lines"),
        F.sort_array(F.transform(F.slice(word, F.lit(1), F.greatest(n - 2, F.lit(0))), triple)).alias(windows))
    found = F.col(windows)
    same = lambda x, i: F.coalesce(x["h"] == F.get(found, i - 1)["h"], F.lit(False)) | F.coalesce(
        x["h"] == F.get(found, i + 1)["h"], F.lit(False))
    places = F.sort_array(F.transform(F.filter(found, same), lambda x: x["at"]))
    zero = F.struct(F.lit(0).alias("covered"), F.lit(0).alias("upto"))
    fold = lambda a, at: F.struct((a["covered"] + at + 3 - F.greatest(at, a["upto"])).alias("covered"), (at + 3).alias("upto"))
    return df.select(
        *keep, "n_words", "word_chars", "n_symbols",
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.aggregate(places, zero, fold, lambda a: a["covered"]).cast("long").alias("n_repeat_words"))


def base_failure(rules: Rules = Rules()) -> Column:
    return (F.col("n_words") < rules.min_words) | (
        F.lit(100) * F.col("n_repeat_words") > F.lit(100 * rules.max_repeat_share) * F.col("n_words"))


def soft_failure(rules: Rules = Rules()) -> Column:
    low, high = rules.word_length
    words, chars = F.col("n_words"), F.col("word_chars")
    return ((F.col("n_symbols") > rules.max_symbol_share * words) | (chars < low * words) | (chars > high * words)
            | (F.col("n_dup_lines") * 10 > rules.max_dup_line_share * words))


def host_rates(measured: DataFrame, host: str, rules: Rules = Rules()) -> DataFrame:
    """One row per host: documents, failures and the shrunk failure rate; failures combine before the shuffle.

    The prior comes from one row of moments over all hosts; hosts that all agree (or a single host) give a prior
    worth ``1e6`` documents, hosts that are all-or-nothing one that is worth nearly none.
    """
    hosts = measured.where(F.col(host).isNotNull()).groupBy(host).agg(
        F.count("*").alias("host_docs"), F.count_if(base_failure(rules) | soft_failure(rules)).alias("host_failures"))
    hosts = materialize(hosts, "hosts")
    rate = F.col("host_failures") / F.col("host_docs")
    mean, spread = hosts.agg(F.avg(rate), F.var_pop(rate)).first()
    mean, spread = mean or 0.0, spread or 0.0
    room = mean * (1 - mean)
    weight = min(1e6, max(1e-6, room / spread - 1)) if spread > 0 else 1e6
    return hosts.withColumn("host_rate", (F.col("host_failures") + mean * weight) / (F.col("host_docs") + weight))


def verdict(measured: DataFrame, hosts: DataFrame, host: str, rules: Rules = Rules()) -> DataFrame:
    """``measured`` with ``base_failed``, ``host_rate`` and ``kept``; Spark broadcasts the hosts only if they are small."""
    key = free_name(measured, "__host")
    joined = measured.join(hosts.select(F.col(host).alias(key), "host_rate"), F.col(host) == F.col(key), "left").drop(key)
    base, soft, rate = base_failure(rules), soft_failure(rules), F.coalesce("host_rate", F.lit(0.0))
    # A sum, not a conjunction: Spark would push the part without the host's rate below the join and into the
    # measures, where it would evaluate arrays once per element.
    reasons = base.cast("int") + soft.cast("int") * (rate > rules.suspect_rate).cast("int") + (rate > rules.blocked_rate).cast("int")
    return joined.withColumn("base_failed", base).withColumn("kept", reasons == 0)


def judge_documents(docs: DataFrame, *, key: str = "doc_id", text: str = "text", host: str = "source",
                    rules: Rules = Rules()) -> DataFrame:
    """``key``, the measures, ``base_failed``, ``host_rate`` and ``kept`` of every row.

    The narrow measures are written once, so texts are measured once and never shuffled.
    """
    narrow = docs.select(F.col(key).alias("__key"), F.col(host).alias("__source"), F.col(text).alias("__text"))
    measured = materialize(measure(narrow, "__text", ("__key", "__source")), "measures")
    hosts = host_rates(measured, "__source", rules)
    return verdict(measured, hosts, "__source", rules).select(
        F.col("__key").alias(key), *MEASURES, "base_failed", "host_rate", "kept")


def keep_good(docs: DataFrame, *, text: str = "text", host: str = "source", rules: Rules = Rules()) -> DataFrame:
    """The rows of ``docs`` that pass, with their columns. Texts are measured twice and not shuffled by a sort:
    the hosts' verdicts come from the first pass, the second filters in place."""
    columns = {c: f"__in_{i}" for i, c in enumerate(docs.columns)}
    own = docs.withColumnsRenamed(columns)
    hosts = materialize(host_rates(measure(own, columns[text], (columns[host],)), columns[host], rules), "verdicts")
    judged = verdict(measure(own, columns[text], tuple(columns.values())), hosts, columns[host], rules)
    return judged.where("kept").select(*[F.col(new).alias(old) for old, new in columns.items()])
