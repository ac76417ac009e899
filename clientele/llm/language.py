"""Language by fused evidence: the text, the declared markup language, and where it was found.

Bayes' rule over the languages of the labelled texts. The text's likelihood is a product over
its byte trigrams, tempered so that a long text counts as at most EVIDENCE independent ones. The
prior of a host shrinks towards that of its address suffix, which shrinks towards that of all
rows; a declared language multiplies by how often texts of each language declare it. Priors and
declarations are grouped sums of the text-only posteriors, without the row's own share, so a
row is not its own witness there; the trigram table holds all labelled texts, its own too.

Trigram counts come from all labelled texts, hashed into BINS bins. The table of bins by languages
is broadcast in blocks of BLOCK_LANGUAGES columns, 128 KB a language; more languages take a further
pass over the texts for each block, so there may be any number of them. A task counts the trigrams
of at most HELD_LANGUAGES languages at once and passes them on before it starts others.

Nulls and ties: a null or empty text has a flat likelihood and takes its language from the other
evidence; a null host, suffix or declaration is a group of its own or no evidence; without any
labelled text the language is null. Equal posteriors go to the language first by code point.
Repeated rows count as often as they come. A text of any length is counted whole, in arrays of
the number of bins. Other columns are not read and may have any name; an empty table gives none.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.llm.common import documents, store, text_blocks

BINS = 1 << 14
BLOCK_LANGUAGES = 256
HELD_LANGUAGES = 64
EVIDENCE = 60.0
#: Rows that the level above counts for, in a prior and in a declaration.
PRIOR_ROWS = 5.0
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _trigrams(text: str) -> np.ndarray:
    data = np.frombuffer(text.lower().encode(), dtype=np.uint8).astype(np.uint64)
    if len(data) < 3:
        return np.zeros(0, dtype=np.int64)
    code = (data[:-2] << np.uint64(16)) | (data[1:-1] << np.uint64(8)) | data[2:]
    return ((code * _MIX) >> np.uint64(64 - 14)).astype(np.int64)


def _label_counts(batches):
    def sums(counts):
        for lang, row in counts.items():
            bins = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(bins), pa.string()), pa.array(bins, pa.int32()),
                 pa.array(row[bins])],
                ["lang", "bin", "n"],
            )

    counts: dict[str, np.ndarray] = {}
    for block in text_blocks(batches, "text"):
        for lang, text in zip(block["lang"], block["text"], strict=True):
            if lang not in counts:
                if len(counts) >= HELD_LANGUAGES:
                    yield from sums(counts)
                    counts = {}
                counts[lang] = np.zeros(BINS, dtype=np.int64)
            if text:
                counts[lang] += np.bincount(_trigrams(text), minlength=BINS)
    yield from sums(counts)


def trigram_counts(labelled: DataFrame) -> tuple[list[str], DataFrame]:
    """Languages in order, and (lang, bin, n) of all rows of ``labelled`` that have a language."""
    known = labelled.where(F.col("lang").isNotNull()).select("lang", "text")
    counted = known.mapInArrow(_label_counts, "lang string, bin int, n bigint")
    sums = store(counted.groupBy("lang", "bin").agg(F.sum("n").alias("n")), "trigrams")
    langs = [r.lang for r in sums.select("lang").distinct().collect()]
    return sorted(langs, key=str.encode), sums


def _log_table(langs: list[str], sums: DataFrame) -> np.ndarray:
    """Log probability of each bin (rows) in each of the languages (columns)."""
    table = np.full((BINS, len(langs)), 0.5)
    place = sums.sparkSession.createDataFrame(list(enumerate(langs)), "place int, lang string")
    rows = sums.join(F.broadcast(place), "lang").select("bin", "place", "n").toArrow()
    bins, places, n = (rows.column(c).to_numpy() for c in ("bin", "place", "n"))
    table[bins, places] += n
    return np.log(table / table.sum(axis=0))


def trigram_model(labelled: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages in order, and the log probability of each bin (rows) in each (columns).

    ``labelled`` has lang and text; rows without a language are left out.
    """
    langs, sums = trigram_counts(labelled)
    return langs, _log_table(langs, sums) if langs else np.zeros((BINS, 0))


def _likelihoods(batches, model, kept, first: bool, last: bool):
    """Adds the model's languages to ``p``: log likelihoods, after the last ones posteriors."""
    for block in text_blocks(batches, "text"):
        rows = []
        for i, text in enumerate(block["text"]):
            grams = _trigrams(text or "")
            total = np.bincount(grams, minlength=BINS) @ model.value
            total *= EVIDENCE / (len(grams) + EVIDENCE)
            if not first:
                total = np.concatenate([block["p"][i], total])
            if last:
                total = np.exp(total - total.max())
                total /= total.sum()
            rows.append(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(block[k], pa.int64() if k == "number" else pa.string()) for k in kept]
            + [pa.array(rows, pa.list_(pa.float64()))],
            [*kept, "p"],
        )


def _posteriors(evidence: DataFrame, langs: list[str], sums: DataFrame, keys: list[str]) -> DataFrame:
    """The keys of every row and ``p``, the text's posterior of each language."""
    rows = evidence.select(*keys, "text")
    for at in range(0, len(langs), BLOCK_LANGUAGES):
        first, last = at == 0, at + BLOCK_LANGUAGES >= len(langs)
        table = _log_table(langs[at:at + BLOCK_LANGUAGES], sums)
        model = evidence.sparkSession.sparkContext.broadcast(table)
        kept = keys if last else [*keys, "text"]
        schema = ", ".join(f"{k} {'bigint' if k == 'number' else 'string'}" for k in kept)
        add = partial(_likelihoods, model=model, kept=kept, first=first, last=last)
        rows = store(rows.mapInArrow(add, f"{schema}, p array<double>"), "posteriors")
    return rows


def fuse_languages(evidence: DataFrame, labelled: DataFrame) -> DataFrame:
    """number, kind, lang, score, text_lang, declared of every row of ``evidence``.

    ``evidence``: number (bigint), kind, host, suffix, declared (text), text.
    """
    keys = ["number", "kind", "host", "suffix", "declared"]
    langs, counts = trigram_counts(labelled)
    if not langs:
        empty = F.lit(None).cast("string")
        return evidence.select(
            "number", "kind", empty.alias("lang"), F.lit(None).cast("double").alias("score"),
            empty.alias("text_lang"), "declared",
        )
    rows = _posteriors(evidence, langs, counts, keys)
    n = range(len(langs))
    p = [F.col("p")[i] for i in n]

    def sums(name: str, *by: str) -> DataFrame:
        return store(
            rows.groupBy(*by).agg(F.array(*[F.sum(x) for x in p]).alias(name)), name
        ).withColumnsRenamed({k: f"{name}_{k}" for k in by})

    overall = rows.agg(*[F.sum(x).alias(str(i)) for i, x in enumerate(p)]).first()
    all_rows = [float(overall[i] or 0.0) for i in n]
    share = [x / sum(all_rows) if sum(all_rows) else 1 / len(langs) for x in all_rows]
    by_suffix, by_host = sums("of_suffix", "suffix"), sums("of_host", "host", "suffix")
    by_declared = sums("of_declared", "declared")
    declared = rows.where(F.col("declared").isNotNull()).agg(
        *[F.sum(x).alias(str(i)) for i, x in enumerate(p)]
    ).first()
    declaring = [float(declared[i] or 0.0) for i in n]
    joined = (
        rows.join(by_suffix, F.col("suffix").eqNullSafe(F.col("of_suffix_suffix")), "left")
        .join(by_host, F.col("host").eqNullSafe(F.col("of_host_host"))
              & F.col("suffix").eqNullSafe(F.col("of_host_suffix")), "left")
        .join(by_declared, F.col("declared") == F.col("of_declared_declared"), "left")
    )
    total = lambda name: F.aggregate(name, F.lit(0.0), lambda a, x: a + x)
    of_all, of_declaring = (F.array(*map(F.lit, x)) for x in (share, declaring))
    k = PRIOR_ROWS
    sums_of = {f"all_{x}": total(f"of_{x}") for x in ("suffix", "host", "declared")}

    def post(i):
        own = F.get("p", i)
        of_suffix = (F.get("of_suffix", i) - own + k * F.get(of_all, i)) / (F.col("all_suffix") - 1 + k)
        of_host = F.when(F.col("host").isNull(), of_suffix).otherwise(
            (F.get("of_host", i) - own + k * of_suffix) / (F.col("all_host") - 1 + k)
        )
        rate = F.col("all_declared") / F.lit(max(sum(declaring), 1e-9))
        says = (F.get("of_declared", i) - own + k * rate) / (F.get(of_declaring, i) + k - own)
        fused = own * of_host * F.when(F.col("declared").isNull(), 1.0).otherwise(says)
        return F.greatest(fused, F.lit(0.0))

    fused = joined.withColumns(sums_of).withColumn(
        "post", F.transform(F.sequence(F.lit(0), F.lit(len(langs) - 1)), post)
    )
    names = F.array(*map(F.lit, langs))
    place = lambda c: F.array_position(c, F.array_max(c)).cast("int")
    return fused.select(
        "number", "kind", F.element_at(names, place(F.col("post"))).alias("lang"),
        (F.array_max("post") / total("post")).alias("score"),
        F.element_at(names, place(F.col("p"))).alias("text_lang"), "declared",
    )


def page_evidence(pages: DataFrame) -> DataFrame:
    """Evidence of raw web pages: the visible text, the declared language, host and suffix."""
    html = F.coalesce("html", F.lit(""))
    hidden = r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>"
    host = F.lower(F.try_parse_url("url", F.lit("HOST")))
    said = F.lower(F.regexp_extract(html, r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]+)", 1))
    return pages.select(
        F.col("page_id").cast("bigint").alias("number"), F.lit("page").alias("kind"),
        host.alias("host"), F.substring_index(host, ".", -1).alias("suffix"),
        F.nullif(said, F.lit("")).alias("declared"),
        F.regexp_replace(html, hidden, " ").alias("text"),
    )


def document_evidence(docs: DataFrame) -> DataFrame:
    """Evidence of plain documents, whose source stands for the host."""
    none = F.lit(None).cast("string")
    return docs.select(
        F.col("doc_id").cast("bigint").alias("number"), F.lit("document").alias("kind"),
        F.col("source").alias("host"), none.alias("suffix"), none.alias("declared"), "text",
    )


def op3_language(spark: SparkSession, folder: str) -> DataFrame:
    """Every page and every document; page_id or doc_id says which."""
    docs = documents(spark, folder)
    pages = spark.read.parquet(f"{folder.rstrip('/')}/pages.parquet")
    evidence = page_evidence(pages).unionByName(document_evidence(docs))
    found = fuse_languages(evidence, docs.select("lang", "text"))
    own = lambda kind: F.when(F.col("kind") == kind, F.col("number"))
    return found.select(
        own("document").alias("doc_id"), own("page").alias("page_id"), "lang", "score",
        "text_lang", "declared",
    )
