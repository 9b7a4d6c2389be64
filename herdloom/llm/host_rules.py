"""Quality rules per document and per host, in DataFrame expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from herdloom.llm.base import stored

# White space between words, and characters that count as symbols.
SPACE = "[\\x20\\x09-\\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

#: Rules of a document, on words, symbols per word, share of repeated lines and share of repeated words.
FEW_WORDS, MANY_SYMBOLS, MANY_DUP_LINES, MANY_REPEATS = 50, 0.1, 0.3, 0.5
RULES = ("short", "symbols", "lines", "repeats")
#: A host fails a rule when more than this share of its documents does, after shrinking.
HOST_LIMIT = 0.5


def _size(array: Column) -> Column:
    return F.size(array).cast("bigint")


def _without(column: str, characters: str) -> Column:
    return F.length(F.translate(F.col(column), characters, ""))


def document_counts(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", host_column: str = "source"):
    """Counts of every whole text by built-in functions; NULL has no words.

    Repeated words: the windows of three words are put in order, equal neighbours name the places that
    occur again, and the words that those places cover are counted. All of it stays within the row, n log
    n for a text of n words, and rows are never multiplied.
    """
    base = df.select(
        F.col(id_column).alias("doc_id"),
        F.col(host_column).alias("host"),
        F.coalesce(F.col(text_column), F.lit("")).alias("body"),
    )
    cut = base.withColumns(
        {
            "words": F.array_remove(F.split("body", SPACE), ""),
            "lines": F.filter(F.split("body", "\n"), lambda line: F.length(F.translate(line, SPACES, "")) > 0),
        }
    ).withColumn("n", F.size("words"))
    last = F.greatest(F.col("n") - 2, F.lit(0))
    windows = F.arrays_zip(
        F.slice("words", F.lit(1), last).alias("a"),
        F.slice("words", F.lit(2), last).alias("b"),
        F.slice("words", F.lit(3), last).alias("c"),
        F.slice(F.sequence(F.lit(0), F.greatest(F.col("n"), F.lit(1))), F.lit(1), last).alias("at"),
    )
    ordered = cut.select(
        "doc_id",
        "host",
        F.col("n").cast("bigint").alias("n_words"),
        _without("body", SPACES).cast("bigint").alias("word_chars"),
        (F.length("body") - _without("body", SYMBOLS)).cast("bigint").alias("n_symbols"),
        (_size(F.col("lines")) - _size(F.array_distinct("lines"))).alias("n_dup_lines"),
        _size(F.col("lines")).alias("n_lines"),
        F.sort_array(windows).alias("windows"),
    )
    rest = F.greatest(F.size("windows") - 1, F.lit(0))
    pairs = F.arrays_zip(F.slice("windows", F.lit(1), rest).alias("x"), F.slice("windows", F.lit(2), rest).alias("y"))
    same = F.filter(
        pairs, lambda p: (p.x.a == p.y.a) & (p.x.b == p.y.b) & (p.x.c == p.y.c)
    )
    places = ordered.withColumn("same", same).drop("windows")
    places = places.withColumn(
        "places",
        F.sort_array(F.array_distinct(F.concat(F.transform("same", lambda p: p.x.at), F.transform("same", lambda p: p.y.at)))),
    ).drop("same")
    following = F.slice("places", F.lit(2), F.greatest(F.size("places"), F.lit(1)))
    steps = F.zip_with("places", following, lambda at, after: F.least(F.coalesce(after - at, F.lit(3)), F.lit(3)))
    covered = F.aggregate(steps, F.lit(0).cast("bigint"), lambda total, step: total + step)
    return places.withColumn("n_repeat_words", covered).drop("places")


def host_verdicts(failures: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """(host, host_failed) from (host, one column per rule: 1 where a document fails it).

    The prior of a rule is the beta distribution whose mean and variance are those of the rates of all
    hosts, each weighed by its documents. A host's rate is shrunk towards the mean: (failures + a) /
    (documents + a + b). Hosts whose rates don't differ get the mean. Rows without a host are left out.
    """
    hosts = (
        failures.filter(F.col("host").isNotNull())
        .groupBy("host")
        .agg(F.count("*").alias("n"), *(F.sum(r).alias(r) for r in RULES))
    )
    moments = []
    for rule in RULES:
        rate = F.col(rule) / F.col("n")
        moments += [
            (F.sum(rule) / F.sum("n")).alias(f"{rule}_mean"),
            (F.sum(F.col("n") * rate * rate) / F.sum("n")).alias(f"{rule}_square"),
        ]
    prior = hosts.agg(F.struct(*moments).alias("prior"))
    rated = hosts.withColumn("prior", prior.scalar())
    failed = F.lit(False)
    for rule in RULES:
        mean = F.col(f"prior.{rule}_mean")
        variance = F.greatest(F.col(f"prior.{rule}_square") - mean * mean, F.lit(1e-12))
        weight = F.greatest(mean * (1 - mean) / variance - 1, F.lit(0.0))
        failed = failed | ((F.col(rule) + weight * mean) / (F.col("n") + weight) > limit)
    return rated.select("host", failed.alias("host_failed"))


def judge(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", host_column: str = "source") -> DataFrame:
    """Counts, base verdict and final verdict of every row of ``df``, repeated ones too.

    A document fails if a base rule does or its host fails. NULL and empty texts have no words and fail;
    a row without a host is judged by itself. Only the three named columns are read. The counts are
    stored once; hosts are summed per task before the shuffle, and the join back to documents splits a
    host that has a third of them.
    """
    counts = stored(document_counts(df, id_column, text_column, host_column), "rule-counts")
    repeats = 100 * F.col("n_repeat_words") > 100 * MANY_REPEATS * F.col("n_words")
    fails = {
        "short": F.col("n_words") < FEW_WORDS,
        "symbols": F.col("n_symbols") > MANY_SYMBOLS * F.col("n_words"),
        "lines": F.col("n_dup_lines") > MANY_DUP_LINES * F.col("n_lines"),
        "repeats": repeats,
    }
    failures = counts.select("host", *(fails[r].cast("bigint").alias(r) for r in RULES))
    judged = counts.withColumn("base_failed", fails["short"] | repeats).join(host_verdicts(failures), "host", "left")
    host_failed = F.coalesce("host_failed", F.lit(False))
    return judged.select(
        F.col("doc_id").alias(id_column),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        host_failed.alias("host_failed"),
        (~F.col("base_failed") & ~host_failed).alias("kept"),
    )
