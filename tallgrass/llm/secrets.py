"""Secret scans: character Markov models of random strings and of ordinary identifiers, by log-likelihood ratio.

Spans of three known shapes (assigned values, access keys, long hex) are found by pattern. Two Markov chains are trained
from labelled samples. Random: the values of the known spans, and strings dealt from hashes in the alphabets that keys
come in (hex, base64, its URL form, letters and digits, upper case). Ordinary: letter-only tokens, and identifiers as code
and paths have them (snake, camel and kebab case, paths, versions, years), made of the corpus's own neighbouring words. A
token of TOKEN's shape outside the known spans is a secret where the random chain is likelier by least_ratio (natural
log). Everything is DataFrame functions; the model is a fixed-size table of character pairs.

Defined results: null text counts as empty and has no spans; doc_id may be null or repeated, every row is returned;
without any word in the corpus only the known shapes are reported; an empty table gives an empty result; extra columns
are ignored. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import settle

KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
#: The longest runs are found either way, so the least length can stand in the pattern.
HEX = r"[0-9a-f]{16,}"
TOKEN = r"[A-Za-z0-9+/_=-]{16,}"
ORDINARY = r"^[A-Za-z_-]+$"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
WIDTH = len(ALPHABET) + 1


def spans(text: Column, pattern: str, kind: int, group: int = 0, least: int = 0) -> Column:
    """array<struct<start, kind, end, value>> of the pattern's leftmost matches; value is the group, least its length.

    The pieces between matches give the offsets."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    zipped = F.arrays_zip(whole.alias("w"), value.alias("v"), F.slice(F.split(text, pattern, -1), 1, F.size(whole)).alias("g"))
    kind_of = "array<struct<start:int,kind:int,end:int,value:string>>"

    def step(acc: Column, m: Column) -> Column:
        start = acc["at"] + F.length(m["g"])
        end = start + F.length(m["w"])
        found = F.array(F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), m["v"].alias("value")))
        return F.struct(end.alias("at"), F.when(F.length(m["v"]) >= least, F.concat(acc["found"], found)).otherwise(acc["found"]).alias("found"))

    none = F.array().cast(kind_of)
    walked = F.aggregate(zipped, F.struct(F.lit(0).alias("at"), none.alias("found")), step, lambda acc: acc["found"])
    return F.when(F.regexp_like(text, F.lit(pattern)), walked).otherwise(none)


def scanned(docs: DataFrame) -> DataFrame:
    """doc_id, known (spans of the three shapes, in order) and tokens (other spans of TOKEN's shape)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    known = F.array_sort(F.concat(spans(text, ASSIGN, 0, 1, 12), spans(text, ACCESS, 1), spans(text, HEX, 2)))
    rows = docs.select("doc_id", known.alias("known"), spans(text, TOKEN, 3).alias("tokens"))
    apart = F.filter("tokens", lambda t: ~F.exists("known", lambda k: (k["start"] < t["end"]) & (t["start"] < k["end"])))
    return rows.select("doc_id", "known", apart.alias("tokens"))


def _codes(value: Column) -> Column:
    """Places in ALPHABET, 0 first for the start."""
    return F.concat(F.array(F.lit(0)), F.transform(F.split(value, ""), lambda c: F.position(c, F.lit(ALPHABET))))


def _pairs(codes: Column) -> Column:
    """Each step from one character to the next as one number."""
    return F.zip_with(F.slice(codes, 1, F.size(codes) - 1), F.slice(codes, 2, F.size(codes) - 1), lambda a, b: a * WIDTH + b)


def dealt_strings(spark: SparkSession, many: int = 4000, seed: str = "a") -> DataFrame:
    """(value): random strings of 20 to 43 characters in the alphabets of keys."""
    raw = F.sha2(F.concat(F.lit(seed), F.col("id").cast("string")), 256)
    base = F.regexp_replace(F.base64(F.unhex(raw)), "\\s|=", "")
    forms = [raw, base, F.translate(base, "+/", "-_"), F.translate(base, "+/", ""), F.upper(F.translate(base, "+/", ""))]
    form = F.element_at(F.array(*forms), (F.col("id") % len(forms) + 1).cast("int"))
    return spark.range(many).select(F.substring(form, F.lit(1), (20 + F.pmod(F.xxhash64("id"), F.lit(24))).cast("int")).alias("value"))


def made_identifiers(docs: DataFrame, most: int) -> DataFrame:
    """(value): identifiers made of neighbouring words of at most most texts, the lowest by a hash."""
    texts = docs.select("text").where("text is not null").orderBy(F.xxhash64("text"), "text").limit(most)
    words = F.transform(F.regexp_extract_all("text", F.lit("[A-Za-z]{2,14}"), F.lit(0)), F.lower)
    rows = texts.select(words.alias("w")).where(F.size("w") >= 3)
    cap = lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 20))

    def made(i: Column) -> Column:
        a, b, c = (F.element_at("w", i + k) for k in range(3))
        n = F.pmod(F.xxhash64(a, b, i), F.lit(10_000))
        year, digit = (1990 + n % 40).cast("string"), (n % 10).cast("string")
        forms = [F.concat_ws("_", a, b, c), F.concat(a, cap(b), cap(c)), F.concat_ws("-", a, b, n.cast("string")), F.concat_ws("/", a, b, c, year), F.concat(cap(a), cap(b), F.lit("_v"), digit, F.lit("-"), (n % 7).cast("string")), F.concat_ws("_", F.upper(a), F.upper(b), year), F.concat(a, b, digit, F.lit("/"), c)]
        return F.element_at(F.array(*forms), (i / 3).cast("int") % len(forms) + 1)

    return rows.select(F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - 2, F.lit(3)), made)).alias("value"))


def pair_counts(samples: DataFrame) -> DataFrame:
    """(random, pair, n): how often each character pair occurs in samples (random, value)."""
    return samples.select("random", F.explode(_pairs(_codes(F.col("value")))).alias("pair")).groupBy("random", "pair").agg(F.count("*").alias("n"))


def ratios(counts: DataFrame) -> list[float] | None:
    """Log-likelihood ratio of each character pair, random against ordinary; None without examples of both."""
    rows = counts.collect()
    table = {True: [0.5] * WIDTH**2, False: [0.5] * WIDTH**2}
    for row in rows:
        table[row["random"]][row["pair"]] += row["n"]
    if {row["random"] for row in rows} != {True, False}:
        return None
    sums = {k: [sum(t[i * WIDTH : (i + 1) * WIDTH]) for i in range(WIDTH)] for k, t in table.items()}
    return [math.log(table[True][p] / sums[True][p // WIDTH]) - math.log(table[False][p] / sums[False][p // WIDTH]) for p in range(WIDTH**2)]


def trained(docs: DataFrame, found: DataFrame, most: int) -> list[float] | None:
    """The model of a corpus. All its known spans and letter-only tokens are samples, and the identifiers of most texts."""
    ordinary = F.filter("tokens", lambda t: F.regexp_like(t["value"], F.lit(ORDINARY)))
    own = found.select(F.explode(F.concat("known", ordinary)).alias("e")).select((F.col("e.kind") < 3).alias("random"), "e.value")
    dealt = dealt_strings(docs.sparkSession).select(F.lit(True).alias("random"), "value")
    return ratios(pair_counts(own.unionByName(dealt).unionByName(made_identifiers(docs, most).select(F.lit(False).alias("random"), "value"))))


def log_ratio(value: Column, model: list[float]) -> Column:
    """How much likelier a value is as a random string than as an ordinary identifier."""
    table = F.split(F.lit(" ".join(f"{x:.6f}" for x in model)), " ").cast("array<double>")
    return F.aggregate(_pairs(_codes(value)), F.lit(0.0), lambda s, p: s + F.element_at(table, p + 1))


def secret_spans(docs: DataFrame, least_ratio: float = 8.0, max_texts: int = 2000) -> DataFrame:
    """doc_id, known and found (likely random tokens); both arrays of struct<start, kind, end, value>, in order.

    max_texts bounds the texts that ordinary identifiers are made of for training; every text is scanned."""
    rows = settle(scanned(docs), "secret-spans")
    model = trained(docs, rows, max_texts)
    if model is None:
        return rows.select("doc_id", "known", F.slice("tokens", 1, 0).alias("found"))
    return rows.select("doc_id", "known", F.filter("tokens", lambda t: log_ratio(t["value"], model) >= least_ratio).alias("found"))


def listed(found: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_spans(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    count = lambda k: F.size(F.filter("known", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{KINDS[k]}") for k in range(3)],
        F.sha2(listed(F.col("known")), 256).alias("base_sha256"),
        listed(F.array_sort(F.concat("known", "found"))).alias("spans"),
    )
