"""New batches against all history (problem 1): a stored, incremental inverted index of rare-token prefixes.

Tokens are the distinct word 5-grams of a text, ordered by a hashed count (fixed size, frozen when the index is founded) and then by hash.
Of a new text and a posted text that share at least ``threshold`` of the smaller one's ``n`` tokens, the first shared token is among the
first ``n - ceil(threshold * n) + 1`` of the smaller one, so they meet at any ratio of their sizes: a smaller posted text by its own
prefix, a larger one by the prefix of the new text. Positions and lengths that don't allow the overlap are dropped at once, and the exact
overlap decides.

The index is four tables below one path, in segments that are only ever added (one a batch): ``counts``; ``keys``, the hashes and
word-sequence classes of all accepted files; ``words``, the word values of one text a class; and ``postings``, all tokens of these texts,
partitioned by token. Accepting a batch reads the index and the batch, never the files or texts accepted before.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.shared import discard, materialize, shared_dir, ship_package, widen
from .hashing import blocks, word_values
from .near_duplicates import K, sequence_class, verified
from .prefixes import count_bits, count_parts, has_token, token_bits, token_rows
from .sketches import spread, table_of

BUCKETS = 16
TABLES = {"counts": "slice int, cells binary", "keys": "key binary, id bigint, fresh boolean", "words": "id bigint, cls binary, words binary", "postings": "token bigint, id bigint, pos int, n int"}


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word-sequence class and word values of each text (id, fresh, text) of at least five words."""
    for b in batches:
        texts = b.column(2).to_pylist()
        for i, j in blocks(texts):
            h, values, off = word_values(texts[i:j])
            raw = np.stack(sequence_class(h, off), 1).tobytes()
            some = np.flatnonzero(np.diff(off) >= K)
            rows = b.slice(i, j - i).take(pa.array(some))
            cls = pa.array([b"c" + raw[16 * r : 16 * r + 16] for r in some], pa.binary())
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), cls, pa.array([values[off[r] : off[r + 1]].tobytes() for r in some], pa.binary())], ["id", "fresh", "cls", "words"])


def _hash_key(prefix: str, col: str) -> Column:
    h = F.lower(F.trim(F.col(col)))
    return F.when(F.length(h) > 0, F.concat(F.lit(prefix).cast("binary"), F.coalesce(F.unhex(h), h.cast("binary"))))


def _nearest(table: DataFrame, key: str) -> DataFrame:
    """Smallest accepted history id and smallest fresh id of each key."""
    return table.groupBy(key).agg(F.min(F.when(~F.col("fresh"), F.col("id"))).alias("old"), F.min(F.when(F.col("fresh"), F.col("id"))).alias("new"))


def _meets(prefix: Broadcast, every: Broadcast, threshold: float):
    """Posting rows that may meet a new text: their token is in a prefix of the batch, or they are in their own prefix and it is in the batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            token, pos, n = (b.column(c).to_numpy(zero_copy_only=False) for c in (0, 2, 3))
            keep = has_token(prefix.value, token)
            own = np.flatnonzero(~keep & (pos <= n - np.ceil(threshold * n - 1e-9)))
            keep[own] = has_token(every.value, token[own])
            yield b.filter(pa.array(keep))

    return run


class PrefixIndex:
    """Stored index of accepted files below ``path``; ``counts`` freezes the token order with the first texts."""

    def __init__(self, spark: SparkSession, path: str, threshold: float = 0.9, band: int = 24, bloom_bits: int = 1 << 23) -> None:
        ship_package(spark)
        self.spark, self.path, self.threshold, self.band, self.bloom_bits = spark, path.rstrip("/"), threshold, band, bloom_bits
        self._bc: Broadcast | None = None

    def _segments(self, name: str) -> list[str]:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        fs = p.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(p):
            return []
        # a segment counts once it is whole
        done = self.spark._jvm.org.apache.hadoop.fs.Path
        return sorted(s.getPath().toString() for s in fs.listStatus(p) if fs.exists(done(s.getPath(), "_SUCCESS")))

    def table(self, name: str) -> DataFrame:
        have = self._segments(name)
        schema = TABLES[name] + (", bucket int" if name in ("keys", "postings") else "")
        if not have:
            return self.spark.createDataFrame([], schema)
        out = None
        for s in have:
            part = self.spark.read.schema(schema).parquet(s)
            out = part if out is None else out.unionByName(part)
        return out

    def _append(self, name: str, rows: DataFrame) -> DataFrame:
        path = f"{self.path}/{name}/{uuid.uuid4().hex}"
        writer = rows.write.option("compression", "zstd")
        if "bucket" in rows.columns:
            writer = writer.partitionBy("bucket")
        writer.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def _counts(self, words: DataFrame, number: int) -> Broadcast:
        if self._bc is None:
            if not self._segments("counts"):
                self._append("counts", count_parts(words, count_bits(number)))
            size = self.table("counts").agg(F.sum(F.length("cells"))).first()[0] or 1 << count_bits(0)
            self._bc = spread(words, table_of(self.table("counts"), size, "uint8")[0])
        return self._bc

    def append(self, files: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Accept ``files`` (id, fresh, hash, normalized_hash, text). Returns their keys and one word row a class of theirs.

        Keys are appended for every file, words and postings only for classes the index doesn't hold yet.
        """
        texts = files.where("text is not null").select("id", "fresh", "text")
        typed = materialize(widen(texts).mapInArrow(_word_rows, "id bigint, fresh boolean, cls binary, words binary"))
        counts = self._counts(typed, typed.count())
        keys = files.select("id", "fresh", F.explode(F.array(_hash_key("h", "hash"), _hash_key("n", "normalized_hash"))).alias("key")).where("key is not null")
        keys = self._append("keys", keys.unionByName(typed.select("id", "fresh", F.col("cls").alias("key"))).distinct().withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(BUCKETS)).cast("int")))
        lead = typed.groupBy("cls").agg(F.min("id").alias("id"))
        known = self.table("words").select("cls", F.lit(True).alias("known"))
        lead = materialize(lead.join(known, "cls", "left") if self._segments("words") else lead.withColumn("known", F.lit(None).cast("boolean")))
        own = materialize(typed.select("id", "cls", "words").join(lead, ["id", "cls"]))
        discard(typed)
        new = self._append("words", own.where("known is null").select("id", "cls", "words"))
        self._append("postings", new.select("id", "words").mapInArrow(token_rows(counts, self.threshold, False, BUCKETS), TABLES["postings"] + ", bucket int"))
        return keys, own.drop("known")

    def probe(self, own: DataFrame) -> DataFrame:
        """Links (a, b, similarity) between texts ``own`` (id, words) and posted texts other than themselves."""
        share = F.ceil(F.lit(self.threshold) * F.least("na", "nb") - 1e-9)
        tokens = materialize(own.select("id", "words").mapInArrow(token_rows(self._bc, self.threshold, False), TABLES["postings"]))
        in_prefix = tokens.where(F.col("pos") <= F.col("n") - F.ceil(F.lit(self.threshold) * F.col("n") - 1e-9))
        prefix, every = (spread(own, token_bits(t, t.count())) for t in (in_prefix, tokens))
        posted = self.table("postings").select("token", "id", "pos", "n").mapInArrow(_meets(prefix, every, self.threshold), TABLES["postings"])
        left = tokens.select("token", F.col("id").alias("a"), F.col("pos").alias("pa"), F.col("n").alias("na"))
        right = posted.select("token", F.col("id").alias("b"), F.col("pos").alias("pb"), F.col("n").alias("nb"))
        met = left.join(right, "token").where((F.col("a") != F.col("b")) & (F.col("pa") <= F.col("na") - share) & (F.col("pb") <= F.col("nb") - share))
        both = met.select("a", "b").distinct()
        pairs = materialize(both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        # a text of the batch whose class was posted before under another id brings its own words
        posted = self.table("words").select("id", "words")
        words = posted.unionByName(own.select("id", "words").join(posted.select("id"), "id", "left_anti"))
        links = verified(pairs, words, self.threshold, self.band, self.bloom_bits)
        for t in (tokens, pairs):
            discard(t)
        return links.select("a", "b", "similarity").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"), "similarity")).join(own.select(F.col("id").alias("a")), "a", "left_semi")

    def accept(self, batch: DataFrame) -> DataFrame:
        """Append ``batch`` (as in :meth:`append`) and give ``(first_file_id, file_id)`` of its files that repeat an accepted one.

        Accepted are all files accepted before that aren't fresh, and fresh ones (before or in this batch) with a smaller id.
        """
        keys, own = self.append(batch)
        links = self.probe(own)
        held = self.table("keys").select("key", "id", "fresh")
        near = materialize(links.select("a", "b").join(self.table("words").select(F.col("id").alias("b"), "cls"), "b").select("a", F.col("cls").alias("key")).distinct())
        meant = keys.select("key").unionByName(near.select("key")).distinct()
        best = materialize(_nearest(held, "key").join(meant, "key", "left_semi"))
        linked = near.join(best, "key").groupBy("a").agg(F.min("old").alias("old"), F.min("new").alias("new"))
        by_class = linked.join(own.select(F.col("id").alias("a"), F.col("cls").alias("key")), "a").select("key", "old", "new")
        # one row a key, hence no hot group in the join with the batch's keys beyond the batch itself
        found = keys.join(best.unionByName(by_class).groupBy("key").agg(F.min("old").alias("old"), F.min("new").alias("new")), "key")
        first = F.least("old", F.when(F.col("new") < F.col("id"), F.col("new")))
        rows = found.select("id", first.alias("first")).where("first is not null")
        return rows.groupBy("id").agg(F.min("first").alias("first_file_id")).select("first_file_id", F.col("id").alias("file_id"))


def accepted_files(state: DataFrame, delta: DataFrame, prints: DataFrame, accepted: tuple[str, ...], min_chars: int) -> DataFrame:
    """(id, fresh, batch_no, hash, normalized_hash, text) of the accepted history files and of all delta files; a repeated row of ``prints`` repeats its file."""
    latest = state.where("file_id is not null").groupBy("file_id").agg(F.max(F.struct("recorded_at", "status", "hash")).alias("s"))
    old = latest.where(F.col("s.status").isin(*accepted)).select(F.col("file_id").alias("id"), F.lit(False).alias("fresh"), F.lit(None).cast("int").alias("batch_no"), F.col("s.hash").alias("hash"))
    new = delta.where("file_id is not null").groupBy("file_id").agg(F.max(F.struct("found_at", "hash")).alias("s"), F.min("batch_no").alias("batch_no")).select(F.col("file_id").alias("id"), F.lit(True).alias("fresh"), "batch_no", F.col("s.hash").alias("hash"))
    ids = materialize(old.unionByName(new).groupBy("id").agg(F.max(F.struct("fresh", "hash", "batch_no")).alias("s")).select("id", "s.fresh", "s.batch_no", "s.hash"))
    text = F.when(F.length("normalized_text") >= min_chars, F.col("normalized_text"))
    docs = prints.where("file_id is not null").select(F.col("file_id").alias("id"), "normalized_hash", text.alias("text"))
    return ids.join(docs, "id", "left")


def match_batches(
    state: DataFrame,
    delta: DataFrame,
    prints: DataFrame,
    accepted: tuple[str, ...] = ("indexed", "duplicate"),
    threshold: float = 0.9,
    min_chars: int = 200,
    cuts: tuple[int, ...] = (),
    path: str | None = None,
) -> DataFrame:
    """``(first_file_id, file_id)`` of every delta file that repeats an accepted file.

    The history founds an index at ``path`` (below the shared folder if None), then the delta files are accepted, all at once or, with
    ``cuts``, in batches of ``batch_no`` up to each cut and one of the rest; a null batch number belongs to the last. Files of an
    earlier batch are taken to have smaller ids. Accepted are history files whose latest ``state`` row has a status in ``accepted``
    and delta files with a smaller id. A file matches by equal hash, equal non-empty normalized hash, or similar text. Of several rows with
    the latest time the one with the greatest (status, hash) counts. Null or blank hashes, null texts, texts below ``min_chars``
    characters or five words match nothing by that means; rows without a file id are ignored; repeated rows count
    once; an id in both tables is fresh. Empty tables give an empty result. Only the columns named here are read.
    """
    spark = delta.sparkSession
    index = PrefixIndex(spark, path or f"{shared_dir(spark)}/docloom-index-{uuid.uuid4().hex}", threshold)
    files = accepted_files(state, delta, prints, accepted, min_chars)
    _, own = index.append(files.where("not fresh").drop("batch_no"))
    discard(own)
    low, out = None, None
    for high in (*sorted(cuts), None):
        n = F.col("batch_no")
        part = F.lit(True) if low is None else n.isNull() | (n > low)
        if high is not None:
            part = part & n.isNotNull() & (n <= high)
        found = index.accept(files.where(F.col("fresh") & part).drop("batch_no"))
        out = found if out is None else out.unionByName(found)
        low = high
    return out


__all__ = ["PrefixIndex", "accepted_files", "match_batches"]
