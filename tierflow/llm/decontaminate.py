"""Benchmark decontamination by winnowing, in DataFrame operations only.

Of every six neighbouring five-word hashes the smallest is kept as a fingerprint, in
texts and benchmark items alike. Ten equal words hold six such hashes, so both sides
keep the same one of them: each shared span of ten words meets in the join. A hit is
then extended along its diagonal over the words themselves, so hashes decide nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.llm.tables import free_name, numbered, scan, stored, table

NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPAN = 10
GRAM = 5
# A fingerprint orders by the hash's upper bits and carries its position in the lower ones.
POSITION = (1 << 30) - 1
FINGERPRINT = "array<struct<h:bigint,at:bigint>>"


def words_of(text: Column) -> Column:
    """Words with A-Z lower-cased and nothing else changed; null has none."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())
    return F.array_remove(F.split(lowered, NO_WORD), "")


def scheme(n_words: int) -> tuple[int, int]:
    """Length of grams and number of neighbours for items with windows of ``n_words`` words.

    ``gram + neighbours - 1`` is the window, so every window holds a fingerprint.
    """
    gram = min(GRAM, n_words)
    return gram, n_words - gram + 1


def fingerprints(df: DataFrame, words: str, gram: int, width: int) -> DataFrame:
    """``df`` without ``words``, a row for each fingerprint ``(h, at)``."""
    others = [c for c in df.columns if c != words]
    size, at = F.size("hashes"), lambda key: key.bitwiseAND(F.lit(POSITION))
    hashed = F.transform(
        F.sequence(F.lit(0), F.size(words) - gram),
        lambda i: F.xxhash64(*[F.get(F.col(words), i + k) for k in range(gram)]),
    )
    smallest = F.transform(
        F.sequence(F.lit(0), size - width),
        lambda i: F.least(*[F.get(F.col("keys"), i + k) for k in range(width)])
        if width > 1
        else F.get(F.col("keys"), i),
    )
    picked = F.transform(
        F.array_distinct(smallest),
        lambda key: F.struct(F.get(F.col("hashes"), at(key).cast("int")).alias("h"), at(key).alias("at")),
    )
    # Shorter texts have null here and no row below; a filter would count all words once more.
    return (
        df.withColumn("hashes", F.when(F.size(words) >= gram + width - 1, hashed))
        .withColumn(
            "keys",
            F.transform(
                F.col("hashes"),
                lambda h, i: h.bitwiseAND(F.lit(~POSITION)).bitwiseOR(i.cast("long")),
            ),
        )
        .select(*others, F.inline(picked))
    )


def _windows(doc: str, item: str, span: str) -> Column:
    """Offsets at which ``span`` words of the two aligned word lists are the same."""
    n = F.least(F.size(doc), F.size(item))
    at = F.when(n >= F.col(span), F.sequence(F.lit(0), n - F.col(span))).otherwise(
        F.array().cast("array<int>")
    )
    return F.filter(
        at,
        lambda i: F.slice(F.col(doc), i + 1, F.col(span)) == F.slice(F.col(item), i + 1, F.col(span)),
    )


def hits(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``_row, n_words, hit`` (positions) and ``item_ids`` of every row of ``documents``.

    ``documents`` has ``_row`` and ``text``; ``benchmark`` has ``item_id`` and ``text``.
    """
    docs = documents.select("_row", words_of(F.col("text")).alias("words"))
    items = stored(
        numbered(benchmark.select("item_id", "text"), "item")
        .select("item", "item_id", words_of(F.col("text")).alias("item_words"))
        .withColumn("span", F.least(F.size("item_words"), F.lit(SPAN)))
        .where("span > 0"),
        "items",
    )
    spans = sorted(r[0] for r in items.select("span").distinct().collect())  # ten values at most
    found = None
    for span in spans:
        gram, width = scheme(span)
        theirs = stored(
            fingerprints(
                items.where(F.col("span") == span).select("item", "item_words"),
                "item_words", gram, width,
            ).select("item", "h", F.col("at").alias("item_at")),
            "fingerprints",
        )
        ours = fingerprints(docs, "words", gram, width)
        part = ours.join(theirs, "h").select(
            "_row", "item", (F.col("at") - F.col("item_at")).alias("diagonal")
        )
        found = part if found is None else found.unionByName(part)
    if found is None:
        return documents.select(
            "_row",
            F.size(words_of(F.col("text"))).cast("long").alias("n_words"),
            F.lit(0).cast("long").alias("n_hit"),
            F.array().cast("array<string>").alias("item_ids"),
        )
    diagonals = stored(found.distinct(), "diagonals")
    sizes = items.select("item", F.size("item_words").alias("n_item"))
    per_doc = diagonals.join(sizes, "item").groupBy("_row").agg(
        F.collect_list(F.struct("item", "diagonal", "n_item")).alias("found")
    )
    # The document's words along each diagonal; a start before the text is cut on both sides.
    start = lambda c: F.greatest(c["diagonal"], F.lit(0).cast("long"))
    aligned = (
        documents.select("_row", "text")
        .join(per_doc, "_row")
        .select("_row", "found", words_of(F.col("text")).alias("words"))
        .select(
            "_row",
            F.explode(
                F.transform(
                    "found",
                    lambda c: F.struct(
                        c["item"].alias("item"),
                        start(c).alias("start"),
                        (start(c) - c["diagonal"]).cast("int").alias("skip"),
                        F.slice(
                            F.col("words"),
                            start(c).cast("int") + 1,
                            c["n_item"] - (start(c) - c["diagonal"]).cast("int"),
                        ).alias("doc_part"),
                    ),
                )
            ).alias("c"),
        )
        .select("_row", "c.*")
        .join(items, "item")
        .withColumn(
            "item_part", F.slice("item_words", F.col("skip") + 1, F.size("item_words"))
        )
        .withColumn("at", _windows("doc_part", "item_part", "span"))
        .where(F.size("at") > 0)
        .select(
            "_row",
            "item_id",
            F.array_distinct(
                F.flatten(
                    F.transform(
                        "at",
                        lambda i: F.sequence(
                            F.col("start") + i, F.col("start") + i + F.col("span") - 1
                        ),
                    )
                )
            ).alias("hit"),
        )
    )
    per_row = aligned.groupBy("_row").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("hit")))).cast("long").alias("n_hit"),
        F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids"),
    )
    sizes = docs.select("_row", F.size("words").cast("long").alias("n_words"))
    return sizes.join(per_row, "_row", "left").select(
        "_row",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
    )


def decontaminate(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` for every row.

    Null and empty texts have no words and no hits. An item of fewer than ten words, but
    not none, is one window; one without words hits nothing. Repeated items count once
    by id; an item without id hits words but is not listed. Repeated documents are
    judged alike. Other columns are ignored. Empty tables give empty or clean results.
    """
    rows = numbered(documents.select("doc_id", "text"))
    found = hits(rows, benchmark)
    return rows.select("_row", "doc_id").join(found, "_row").select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def without_benchmark(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """All columns of the rows in which no benchmark window occurs."""
    documents, row = scan(documents), free_name(documents, "_row")
    found = hits(numbered(documents.select("text")), benchmark)
    gone = stored(found.where("n_hit > 0").select(F.col("_row").alias(row)), "contaminated")
    return numbered(documents, row).join(gone, row, "left_anti").drop(row)


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
