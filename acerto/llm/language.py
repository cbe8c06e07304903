"""Language identification by Bayesian fusion of evidence.

The posterior of a language is the product of
  - the likelihood of the text under byte trigrams, counted as at most `most_trigrams` independent ones,
  - the likelihoods of the declared language and of the address suffix in that language,
  - the prior of the host, smoothed towards that of its domain, and that towards the overall one.
The last three come from grouped counts of what the text alone says, over all rows. A further
hypothesis, "und", under which all trigrams are alike, stands for every other language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from .common import free_held, settle, slices, small_batches, written

_CELLS = 1 << 16
_LOWER = np.arange(256, dtype=np.uint32)
_LOWER[65:91] += 32
_LETTERS = np.array([b == 32 or 97 <= b <= 122 or b >= 128 for b in range(256)])  # after lower-casing


@dataclass(frozen=True)
class Model:
    """Languages, "und" last, and the log-likelihoods of trigram cells in each."""

    languages: tuple[str, ...]
    table: np.ndarray


def _trigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Cells of the byte trigrams of letters and spaces, all texts end to end, and where each text's begin."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = _LOWER[np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]]
    offsets = offsets - offsets[0]
    cells = ((data[:-2] * 961 + data[1:-1] * 31 + data[2:]) * np.uint32(2654435769)) >> np.uint32(16) \
        if len(data) > 2 else np.empty(0, np.uint32)
    letters = _LETTERS[data]
    inside = (letters[:-2] & letters[1:-1] & letters[2:])[:len(cells)]  # and trigrams across two texts do not count
    for back in (1, 2):
        cut = offsets[1:-1] - back
        inside[cut[(cut >= 0) & (cut < len(cells))]] = False
    counts = np.append(0, np.cumsum(inside))
    return cells[inside], counts[np.minimum(offsets, len(cells))]


def _named(declared: Column) -> Column:
    """A declared language by its part before "-" or "_", in lower case; "" where it names none."""
    return F.regexp_extract(F.lower(F.coalesce(declared, F.lit(""))), r"^([\p{L}\p{M}\p{N}]+)", 1)


def train(rows: DataFrame, text_column: str = "text", declared_column: str = "lang", *, sample_rows: int = 3000,
          longest: int = 200_000, least_texts: int = 100, least_share: float = 0.001) -> Model:
    """A model from rows with a declared language: every language that any row with a text declares.

    Declarations are free text, so a language is what has the form of a code (two or three letters a-z), however rare,
    or any other name that at least `least_texts` different texts and `least_share` of all rows with a declaration and a text
    have; rows with other declarations train nothing. So there are no more names than codes of that form and 1 / `least_share`,
    whatever is declared. The languages come from a grouped count over all rows. The sample is bounded for each of them: about
    `sample_rows` of its different texts, all where there are no more, each by its first `longest`
    characters. Trigrams are counted in the tasks; the driver and each worker hold 256 kB for each language.
    "und" and "other" name no language.
    """
    small_batches(rows.sparkSession)
    labelled = rows.where(F.length(text_column) > 0).select(
        _named(F.col(declared_column)).alias("language"), F.col(text_column).alias("text")).where(
        ~F.col("language").isin("", "und", "other"))
    least = max(1.0, least_share * labelled.count())
    supported = (F.col("n") >= least_texts) & (F.col("rows") >= least)
    sizes = {r.language: r.n for r in labelled.groupBy("language").agg(
        F.approx_count_distinct("text", 0.02).alias("n"), F.count("*").alias("rows"))
        .where(F.rlike("language", F.lit("^[a-z]{2,3}$")) | supported).collect()}
    languages = sorted(sizes)
    counts = np.full((len(languages), _CELLS), 0.01, np.float32)
    if languages:
        shares = rows.sparkSession.createDataFrame(pa.table({
            "language": languages, "place": pa.array(range(len(languages)), pa.int32()),
            "share": [int(min(1.0, sample_rows / max(sizes[n], 1)) * 2**31) for n in languages]}))
        picked = (labelled.join(F.broadcast(shares), "language")
                  .where(F.pmod(F.xxhash64("text", F.lit("sample")), F.lit(2**31)) < F.col("share"))
                  .select("place", "text").distinct().select("place", F.substring("text", 1, longest).alias("text")))
        table = (picked.mapInArrow(_counted, "place int, cell int, n bigint").groupBy("place", "cell")
                 .agg(F.sum("n").alias("n")).toArrow())
        counts[table["place"].to_numpy(), table["cell"].to_numpy()] += table["n"].to_numpy()
    found = np.full((_CELLS, len(languages) + 1), -np.log(_CELLS), np.float32)
    for k, row in enumerate(counts):  # 1 more, so that a language without trigrams is less likely than "und"
        found[:, k] = np.log(row / (row.sum(dtype=np.float64) + 1))
    return Model((*languages, "und"), found)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """place, cell, n: numbers of trigrams in the texts of each language, summed within each part of a batch."""
    free_held()
    for batch in batches:
        for part in slices(batch):
            for place in pc.unique(part.column(0)):
                cells = _trigrams(part.column(1).filter(pc.equal(part.column(0), place)))[0]
                counts = np.bincount(cells, minlength=_CELLS)
                used = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(used), place.as_py(), np.int32)), pa.array(used.astype(np.int32)),
                     pa.array(counts[used].astype(np.int64))], names=["place", "cell", "n"])
        settle()


def _scored(rows: DataFrame, model: Model, most_trigrams: int) -> DataFrame:
    """`rows` with text_score: the text's log-likelihood in each language; null without a trigram."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_held()
        for batch in batches:
            for part in slices(batch, 1 << 21):
                cells, bounds = _trigrams(part.column(part.schema.get_field_index("_text")))
                counts = np.diff(bounds)
                scores = np.empty((len(counts), len(model.languages)))
                for k in range(len(model.languages)):
                    sums = np.append(0.0, np.cumsum(model.table[cells, k], dtype=np.float64))
                    scores[:, k] = sums[bounds[1:]] - sums[bounds[:-1]]
                scores *= (np.minimum(counts, most_trigrams) / np.maximum(counts, 1))[:, None]
                scores -= scores.max(axis=1, keepdims=True)
                lists = pa.array([row if n else None for row, n in zip(scores.tolist(), counts)], pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*part.columns, lists], names=[*part.schema.names, "text_score"])
            settle()

    return rows.mapInArrow(work, StructType(
        [*rows.schema.fields, StructField("text_score", ArrayType(DoubleType()))]))


def _best(scores: Column) -> Column:
    """Place (from 1) of the largest element, the first of equals."""
    return F.array_position(scores, F.array_max(scores)).cast("int")


def _added(*lists: Column) -> Column:
    total = lists[0]
    for other in lists[1:]:
        total = F.zip_with(total, other, lambda a, b: a + b)
    return total


def _logs(counts: Column, prior: Column, weight: float) -> Column:
    """Logarithms of the shares of `counts`, smoothed by `weight` counts dealt like `prior`."""
    total = F.aggregate(counts, F.lit(0.0), lambda a, b: a + b)
    return F.zip_with(counts, prior, lambda c, p: F.log((c + weight * p) / (total + weight)))


def identify(rows: DataFrame, model: Model, text: Column, declared: Column, host: Column, domain: Column,
             suffix: Column, *, most_trigrams: int = 60, host_weight: float = 20.0, least: float = 0.5,
             only_accepted: bool = False) -> DataFrame:
    """`rows` with language, probability, accepted; or, `only_accepted`, the accepted rows as they are.

    `text`, `declared`, `host`, `domain` and `suffix` are the evidence, any of them null where there is none;
    the declared language counts by its part before "-" or "_". A row is accepted if its text has more than
    white space, its language is not "und" and its probability at least `least`. Rows with null or empty texts
    are not accepted; their language is what the other evidence says. Ties go to the first language in
    the alphabet. Repeated rows each get their row; an empty table gives an empty result; all other
    columns stay, whatever their names, but for columns that are called like the three of the result, which these replace.

    The text is read twice, for the counts and for the result. The counts are one row for each host,
    domain and suffix; hosts are joined by Spark's choice, with hot ones split by adaptive execution.
    """
    small_batches(rows.sparkSession)
    languages = model.languages
    size = len(languages)
    clean = _named(declared)
    names = F.array(*map(F.lit, languages))
    prepared = rows.select(
        F.struct(*rows.columns).alias("_row"), F.coalesce(text, F.lit("")).alias("_text"), F.coalesce(F.rlike(text, F.lit(r"\S")), F.lit(False)).alias("_filled"),
        F.when(clean == "", None).when(clean.isin(*languages), clean).otherwise("other").alias("_declared"),
        F.coalesce(F.lower(host), F.lit("")).alias("_host"), F.coalesce(F.lower(domain), F.lit("")).alias("_domain"),
        F.coalesce(F.lower(suffix), F.lit("")).alias("_suffix"))
    guessed = (_scored(prepared.select("_text", "_declared", "_host", "_domain", "_suffix"), model, most_trigrams)
               .where("text_score is not null").withColumn("guess", _best(F.col("text_score"))))
    counts = written(guessed.groupBy("_host", "_domain", "_suffix", "_declared", "guess").agg(
        F.count("*").alias("n")), "language-counts")

    def sums(*by: str) -> DataFrame:
        return counts.groupBy(*by).agg(F.array(*(
            F.sum(F.when(F.col("guess") == k, F.col("n")).otherwise(0)).cast("double")
            for k in range(1, size + 1))).alias("counts"))

    overall = [0.0] * size
    for row in counts.groupBy("guess").agg(F.sum("n").alias("n")).collect():  # one for each language
        overall[row.guess - 1] = float(row.n)
    shares = F.array(*(F.lit((c + 1) / (sum(overall) + size)) for c in overall))
    seen: dict[tuple[int, str], int] = {}
    for row in counts.where("_declared is not null").groupBy("guess", "_declared").agg(F.sum("n").alias("n")).collect():
        seen[row.guess - 1, row._declared] = row.n  # languages squared at most
    values = [*languages, "other"]
    said = {}
    known = [sum(seen.get((k, v), 0) for v in values) + 2.0 + 0.1 * (len(values) - 1) for k in range(size)]
    for value in values:  # how likely a language's rows are to declare `value`
        said[value] = [float(np.log((seen.get((k, value), 0) + (2.0 if name == value else 0.1)) / known[k]))
                       for k, name in enumerate(languages)]
    domains = sums("_domain").select("_domain", F.transform(
        _logs(F.col("counts"), shares, host_weight), lambda x: F.exp(x)).alias("domain_share"))
    hosts = written(sums("_host", "_domain").join(domains, "_domain").select(
        "_host", "_domain", _logs(F.col("counts"), F.col("domain_share"), host_weight).alias("_prior")), "language-hosts")
    totals = F.array(*map(F.lit, overall))
    suffixes = written(sums("_suffix").where("_suffix <> ''").select("_suffix", F.zip_with(
        "counts", totals, lambda c, t: F.log((c + 0.5) / (t + 1.0))).alias("_suffix_score")), "language-suffixes")

    nothing = F.array(*(F.lit(0.0) for _ in languages))
    of_declared = rows.sparkSession.createDataFrame(pa.table({
        "_declared": values, "_declared_score": pa.array([said[v] for v in values], pa.list_(pa.float64()))}))
    posterior = _added(F.coalesce("text_score", nothing), F.coalesce("_prior", F.transform(shares, lambda x: F.log(x))),
                       F.coalesce("_declared_score", nothing), F.coalesce("_suffix_score", nothing))
    joined = (_scored(prepared, model, most_trigrams).drop("_text")
              .join(hosts, ["_host", "_domain"], "left").join(suffixes, "_suffix", "left")
              .join(F.broadcast(of_declared), "_declared", "left")
              .withColumn("_posterior", posterior).withColumn("_top", F.array_max("_posterior"))
              .withColumn("language", F.get(names, _best(F.col("_posterior")) - 1))
              .withColumn("probability", 1 / F.aggregate(
                  "_posterior", F.lit(0.0), lambda total, x: total + F.exp(x - F.col("_top")))))
    accepted = F.col("_filled") & (F.col("language") != "und") & (F.col("probability") >= least)
    if only_accepted:
        return joined.where(accepted).select("_row.*")
    others = [c for c in rows.columns if c.lower() not in ("language", "probability", "accepted")]
    return joined.select(*(F.col("_row").getField(c).alias(c) for c in others),
                         "language", "probability", accepted.alias("accepted"))


def of_documents(docs: DataFrame, **options) -> DataFrame:
    """`identify` for documents: lang is the declared language, source the host."""
    none = F.lit(None).cast("string")
    return identify(docs, train(docs), F.col("text"), F.col("lang"), F.col("source"), F.col("source"), none, **options)


def page_columns(pages: DataFrame) -> DataFrame:
    """The evidence of pages (page_id, url, html): text without markup, declared, host, domain, suffix.

    Scripts and styles go with their content, to the end of the page where they are not closed, then everything between < and >
    without another < inside. Null and empty pages have the empty text; a page without an address
    or a declaration has the empty one. Each pattern reads a page in time that grows with its length, however broken it is.
    """
    html = F.coalesce("html", F.lit(""))
    text = F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style)\b[^<>]*>.*?(?:</\1\b[^<>]*>|\z)", " "), r"<[^<>]*>", " ")
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    root = F.regexp_extract(html, r"(?i)<html\b([^<>]*)>", 1)
    return pages.select(
        "page_id", text.alias("text"), F.regexp_extract(root, r"(?i)\slang\s*=\s*[\"']?([A-Za-z]+)", 1)
        .alias("declared"), host.alias("host"), F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1).alias("domain"),
        F.regexp_extract(host, r"([^.]+)$", 1).alias("suffix"))
