"""Document fingerprints by consistent weighted sampling, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skuweave.llm.common import written
from skuweave.llm.splitters import range_of

#: Hash digits kept for each sample in a fingerprint string.
DIGITS = 4


def _uniform(bits: F.Column, k: int) -> F.Column:
    """The k-th 21 bits of a 64-bit hash as a number inside (0, 1)."""
    return (F.shiftrightunsigned(bits, 21 * k).bitwiseAND(F.lit((1 << 21) - 1)) + F.lit(0.5)) / F.lit(float(1 << 21))


def _sample(term: F.Column, k: int, log_weights: list[tuple[F.Column, F.Column]]) -> list[F.Column]:
    """For each weight: a long whose minimum over a document's terms is the document's k-th sample.

    Gamma(2, 1) variables r and c and a uniform b come from hashes of (term, k). t = floor(ln w / r + b) and
    ln a = ln c - r (t - b + 1); the term with the least a, with its t, is the sample. The long holds ln a, in steps of
    2^-20, above 31 bits that stand for (term, t).
    """
    h1, h2 = F.xxhash64(term, F.lit(2 * k)), F.xxhash64(term, F.lit(2 * k + 1))
    r = -F.log(_uniform(h1, 0) * _uniform(h1, 1))
    log_c = F.log(-F.log(_uniform(h2, 0) * _uniform(h2, 1)))
    b = _uniform(h1, 2)
    low = F.lit((1 << 31) - 1).cast("long")
    out: list[F.Column] = []
    for i, (w, lw) in enumerate(log_weights):
        t = F.floor(lw / r + b)
        log_a = log_c - r * (t - b + F.lit(1.0))
        key = F.shiftleft(F.floor(log_a * float(1 << 20)), 32).bitwiseOR(F.shiftrightunsigned(h2, 20).bitwiseXOR(t).bitwiseAND(low))
        out.append(F.when(w == log_weights[0][0], out[0]).otherwise(key) if i else key)  # most terms weigh the same in both
    return out


def fingerprint(terms: DataFrame, keys: list[str], weights: list[str], samples: int) -> DataFrame:
    """(keys, term_hash, weight columns) -> (keys, one array of samples per weight column).

    A weight of 0 (or null) leaves the term out of that weight's signature. The share of equal samples of two
    signatures estimates sum(min(v, w)) / sum(max(v, w)). A key whose weights are all 0 gets nulls in the array.
    """
    logs = [F.when(F.col(w) > 0, F.log(F.col(w))) for w in weights]
    base = terms.select(*keys, "term_hash", *weights, *[x.alias(f"_lw{i}") for i, x in enumerate(logs)])
    made = [_sample(F.col("term_hash"), k, [(F.col(w), F.col(f"_lw{i}")) for i, w in enumerate(weights)]) for k in range(samples)]
    mins = [F.min(made[k][i]).alias(f"_s{i}_{k}") for i in range(len(weights)) for k in range(samples)]
    out = base.groupBy(*keys).agg(*mins)
    return out.select(*keys, *[F.array(*[f"_s{i}_{k}" for k in range(samples)]).alias(w) for i, w in enumerate(weights)])


def signature_text(samples: F.Column) -> F.Column:
    """DIGITS hexadecimal digits of each sample's hash, one after another; '' for a document without terms."""
    return F.array_join(F.transform(samples, lambda s: F.lpad(F.lower(F.hex(s.bitwiseAND(F.lit(16**DIGITS - 1)))), DIGITS, "0")), "")


def likeness(a: F.Column, b: F.Column, samples: int) -> F.Column:
    """Share of equal samples of two fingerprint strings; two without terms are alike, one without and one with are not."""
    same = F.filter(F.sequence(F.lit(0), F.lit(samples - 1)), lambda k: F.substr(a, k * DIGITS + 1, F.lit(DIGITS)) == F.substr(b, k * DIGITS + 1, F.lit(DIGITS)))
    return F.when((a == "") & (b == ""), 1.0).when((a == "") | (b == ""), 0.0).otherwise(F.size(same) / F.lit(float(samples)))


def words(text: F.Column) -> F.Column:
    """The runs of characters that are no ASCII white space, with '' where the text starts or ends with white space."""
    return F.split(text, "[ \\t-\\r]+")


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", samples: int = 24, bucket_bytes: int = 4 << 20, max_buckets: int = 4096) -> DataFrame:
    """Fingerprints of every whole text and of its edited text, and their likeness.

    Terms are words weighted by how often they occur. Edited: the last floor(n_chars / 3) code points are replaced by
    the first as many (or all) of the next document in descending order of the id; after the last comes the first.
    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    Rows go by ranges of the id (quantiles, about bucket_bytes of text each) through one shuffle; the window, the
    counting of terms and the samples' minima then need no other. Hot groups do no harm, as each row is its own group.
    Null text is empty; an empty text's fingerprint is ''. Null ids come last, equal ids are ordered by text. Rows are
    never merged. An empty table gives an empty one; other columns are ignored.
    """
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    size = src.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = int(min(max_buckets, size // bucket_bytes + 1))
    cuts = src.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 20 * n)).first()[0] if n > 1 else []
    bounds = sorted(set(cuts or []))
    src = src.withColumn("bucket", range_of(F.coalesce("doc_id", F.lit(-(1 << 63))), bounds))

    w = Window.partitionBy("bucket").orderBy(F.desc_nulls_last("doc_id"), F.desc("text"))
    every = Window.orderBy(F.desc("bucket"))
    first = F.first("head").over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    heads = src.groupBy("bucket").agg(F.max(F.struct("doc_id", "text")).alias("head"))  # one row for each range
    heads = heads.select("bucket", F.coalesce(F.lead("head").over(every), first)["text"].alias("head_text"))
    rows = src.select("bucket", "doc_id", "text", F.row_number().over(w).alias("n"), F.lead("text").over(w).alias("next_text"))
    rows = rows.join(heads, "bucket").select("bucket", "doc_id", "n", "text", F.coalesce("next_text", "head_text").alias("next_text"), F.length("text").cast("long").alias("n_chars"))
    third = F.floor(F.col("n_chars") / 3).cast("int")
    edited = F.concat(F.left("text", F.col("n_chars").cast("int") - third), F.left("next_text", third))
    rows = rows.select("bucket", "n", "doc_id", "n_chars", words(F.col("text")).alias("own"), edited.alias("edited"))
    meta = rows.select("bucket", "n", "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"))
    both = rows.select("bucket", "n", F.size("own").alias("n_own"), F.concat("own", words(F.col("edited"))).alias("all"))
    both = both.select("bucket", "n", "n_own", F.posexplode("all"))
    mine = (F.col("pos") < F.col("n_own")).cast("int")
    terms = both.groupBy("bucket", "n", F.when(F.col("col") != "", F.xxhash64("col")).alias("term_hash")).agg(F.sum(mine).alias("own"), F.sum(1 - mine).alias("edited"))
    terms = terms.select("bucket", "n", "term_hash", *[F.when(F.col("term_hash").isNotNull(), F.col(c)).otherwise(F.lit(0)).alias(c) for c in ("own", "edited")])
    signed = fingerprint(terms, ["bucket", "n"], ["own", "edited"], samples)
    signed = signed.select("bucket", "n", signature_text(F.col("own")).alias("fingerprint"), signature_text(F.col("edited")).alias("edited_fingerprint"))
    done = written(meta.join(signed, ["bucket", "n"]), "fingerprints")

    heads = done.where("n = 1").select("bucket", F.col("fingerprint").alias("head"))
    first = F.first("head").over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    heads = heads.select("bucket", F.coalesce(F.lead("head").over(every), first).alias("head"))
    after = F.coalesce(F.lead("fingerprint").over(Window.partitionBy("bucket").orderBy("n")), "head")
    return done.join(heads, "bucket").withColumn("after", after).select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint"), samples).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("after"), samples).alias("near_next"),
    )
