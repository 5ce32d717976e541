"""N-gram Jaccard join with adaptive multi-match prefixes.

Which documents link: those whose sets of five-word shingles have
100 * |A and B| >= threshold * |A or B|.  One row per document comes out: its class (connected
component of links) and its number of links.  No pair is lost; a shingle is a 64-bit hash
of five words' hashes (sums modulo a prime, for two bases), on which intersections are counted.

How: shingles are ordered by how many different sets hold them, rarest first.  A pair that
links shares at least l shingles among the first (n - ceil(t n) + l) of each of the two
sets, for every l.  A document whose prefix for l = 1 holds only shingles of its own has no
partner and leaves the join there; that is nearly every document.  The others get the l for
which the estimated cost (postings to look through, and candidates to verify) is least, and
a posting for each shingle of that prefix.  A pair is a candidate if it shares as many
shingles as the smaller l of the two asks, in the prefixes for that l; candidates are
verified in full.

Shingles of at most `wide` postings give pairs: equal posting lists are counted once, and
pairs are added up over them.  Wider shingles are those of large groups of near copies, whose
pairs aren't listed: their documents form families (components), which are compared by
blocks, of neighbouring classes of set size only, as one matrix product for the shared
prefix shingles and one for the verification.  Blocks return a spanning forest and link
counts.  A pair of one family is left to its blocks, which see all shingles; a pair of two
families shares no wide shingle.

Scale: equal sets are one node from the start.  Shingle frequencies are counted without
moving a row per shingle: a chunk of documents sends each bucket of the hash space one
packed message of remainders, and gets back one byte for each (remainders that clash only
make a shingle seem more frequent).  A frequent shingle is one entry a chunk.  Chunks and
buckets grow with the square root of the corpus beyond `GROWN_FROM` bytes, so that messages
grow with the corpus.  Blocks are bounded in documents and shingles.  A family that many
shingles in many contexts chain together costs the square of its neighbouring size classes.

Nulls and texts without words are empty sets and link with nothing; their component is
their own doc_id.  Repeated rows are documents of their own that link with each other.
Of values of l with equal cost the least is taken.  A very long text is a chunk of its own.
An empty table gives no rows.  Further columns of the input are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import beside_least, connected, join_by_count
from .kernel import byte_view, release, shingle_sets, slices
from .packing import by_bucket, coded, pack, squeeze, unpack, unsqueeze
from .shared import grown, parts, stored, table, tasks, text_bytes

CHUNK_BYTES, GROWN_FROM = 8 << 20, 32 << 30
BUCKET_SHINGLES = 2 << 20
BLOCK_DOCS, BLOCK_SHINGLES = 256, 1 << 20
MOST_MATCHES, WIDE = 8, 8


def _sets(texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted shingle hashes) of every row that has words."""
    data, offsets = byte_view(texts)
    for lo, hi in slices(offsets):
        hashes, doc = shingle_sets(data, offsets[lo : hi + 1])
        bounds = np.searchsorted(doc, np.arange(hi - lo + 1))
        for k in range(hi - lo):
            if bounds[k] < bounds[k + 1]:
                yield lo + k, hashes[bounds[k] : bounds[k + 1]]


def _digest(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes, digest_size=16).digest()


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, digest of the set; null where it is empty) of every document."""

    def run(batches):
        for batch in batches:
            n, digests = np.zeros(batch.num_rows, np.int64), [None] * batch.num_rows
            for row, hashes in _sets(batch.column(1)):
                n[row], digests[row] = len(hashes), _digest(hashes)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(digests, pa.binary())], ["doc_id", "n_shingles", "digest"])
        release()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, n_shingles long, digest binary")


def _distinct_sets(docs: DataFrame, text_col: str, chunks: int) -> DataFrame:
    """(chunk, digest, text): texts, at most one a set from each input partition."""

    def run(batches):
        seen: set[bytes] = set()
        for batch in batches:
            rows, digests = [], []
            for row, hashes in _sets(batch.column(0)):
                if (d := _digest(hashes)) not in seen:
                    seen.add(d)
                    rows.append(row)
                    digests.append(d)
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), batch.column(0).take(pa.array(rows, pa.int64()))], ["digest", "text"])
        release()

    found = docs.select(F.col(text_col).cast("string").alias("text")).where("text is not null").mapInArrow(run, "digest binary, text string")
    dealt = found.withColumn("chunk", F.pmod(F.xxhash64("digest"), F.lit(chunks)).cast("int"))
    return dealt.repartition(tasks(docs.sparkSession, chunks), "chunk")


def _chunk_sets(chunk: pa.Table) -> tuple[list[bytes], list[np.ndarray]]:
    """The chunk's distinct sets, in the order of their digests."""
    digests = chunk.column("digest").to_pylist()
    first: dict[bytes, int] = {}
    for i, d in enumerate(digests):
        first.setdefault(d, i)
    names = sorted(first)
    texts = chunk.column("text").combine_chunks().take(pa.array([first[d] for d in names], pa.int64()))
    return names, [hashes for _, hashes in _sets(texts)]


def _frequencies(texts: DataFrame, buckets: int) -> tuple[DataFrame, callable]:
    """Replies (chunk, bucket, levels): 0 for a shingle that one set has, else 1 + 16 log2 of the number of sets."""

    def send(chunk: pa.Table) -> pa.Table:
        release()
        names, sets = _chunk_sets(chunk)
        codes, counts = np.unique(coded(np.concatenate(sets), buckets), return_counts=True) if sets else (np.zeros(0, np.uint64), np.zeros(0))
        rows = [(b, pack(codes[lo:hi].astype(np.uint32)), squeeze(counts[lo:hi].astype(np.uint32))) for b, lo, hi in by_bucket(codes)]
        c = chunk.column("chunk")[0].as_py() if chunk.num_rows else 0
        return pa.table([pa.array([c] * len(rows), pa.int32()), *(pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int32(), pa.binary(), pa.binary())))], ["chunk", "bucket", "codes", "counts"])

    def answer(bucket: pa.Table) -> pa.Table:
        release()
        codes = [unpack(x) for x in bucket.column("codes").to_pylist()]
        counts = [unsqueeze(x, np.uint32) for x in bucket.column("counts").to_pylist()]
        known, at = np.unique(np.concatenate(codes), return_inverse=True)
        total = np.bincount(at, weights=np.concatenate(counts), minlength=len(known))
        level = np.where(total < 2, 0, np.minimum(255, 1 + np.round(16 * np.log2(np.maximum(total, 1))))).astype(np.uint8)[at]
        cuts = np.cumsum([0, *map(len, codes)])
        return pa.table([bucket.column("chunk"), bucket.column("bucket"), pa.array([squeeze(level[lo:hi]) for lo, hi in zip(cuts[:-1], cuts[1:])], pa.binary())], ["chunk", "bucket", "levels"])

    sent = texts.groupBy("chunk").applyInArrow(send, "chunk int, bucket int, codes binary, counts binary")
    return sent.repartition(tasks(texts.sparkSession, buckets), "bucket").groupBy("bucket").applyInArrow(answer, "chunk int, bucket int, levels binary")


def _matches(levels: np.ndarray, n: int, first: int, alone: int, most: int) -> int:
    """The l of least estimated cost for a document of n shingles; its shared ones have these levels, rarest first."""
    lists = np.cumsum(2.0 ** ((levels - 1.0) / 16))
    best, least = 1, None
    for ell in range(1, most + 1):
        size = first + ell - 1 - alone
        if size > len(levels):
            break
        met = lists[size - 1]
        cost = met + met / ell * np.log2(n + 1)
        if least is None or cost < least:
            best, least = ell, cost
    return best


def candidates(texts: DataFrame, replies: DataFrame, buckets: int, threshold: int, most: int = MOST_MATCHES) -> DataFrame:
    """(digest, n, first, alone, ell, codes, prefix) of the sets that may have a partner.

    codes: the shingles that other sets hold too, rarest first; prefix: those of the prefix for l = ell;
    first: length of the prefix for l = 1; alone: the set's own shingles, which come before codes.
    """

    def run(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        release()
        names, sets = _chunk_sets(chunk)
        rows = []
        if sets:
            known = np.unique(coded(np.concatenate(sets), buckets))
            order = np.argsort(answers.column("bucket").to_numpy(), kind="stable")
            packed = answers.column("levels").to_pylist()
            levels = np.concatenate([unsqueeze(packed[i], np.uint8) for i in order])
            for name, hashes in zip(names, sets):
                codes = coded(hashes, buckets)
                level = levels[np.searchsorted(known, codes)]
                n = len(codes)
                first, alone = n - -(-threshold * n // 100) + 1, int((level == 0).sum())
                if alone >= first:
                    continue
                order = np.lexsort((hashes, level))[alone:]
                shared, level = hashes[order], level[order].astype(np.float64)
                ell = _matches(level, n, first, alone, most)
                rows.append((name, n, first, alone, ell, shared.tobytes(), shared[: first + ell - 1 - alone].view(np.int64)))
        kinds = (pa.binary(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int64()))
        return pa.table([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], ["digest", "n", "first", "alone", "ell", "codes", "prefix"])

    return texts.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(run, "digest binary, n int, first int, alone int, ell int, codes binary, prefix array<long>")


def _shared(rows: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """How many codes each two rows have in common; each row's codes are distinct."""
    g = len(rows)
    known, at, seen = np.unique(np.concatenate(rows), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(g), [len(r) for r in rows])
    use = seen[at] > 1
    place = np.cumsum(seen > 1) - 1
    at, owner = place[at[use]], owner[use]
    out = np.zeros((g, g), np.float32)
    order = np.argsort(at, kind="stable")
    at, owner = at[order], owner[order]
    for lo in range(0, int(at[-1]) + 1 if len(at) else 0, columns):
        i, j = np.searchsorted(at, [lo, lo + columns])
        held = np.zeros((g, min(columns, int(at[j - 1]) - lo + 1)), np.float32)
        held[owner[i:j], at[i:j] - lo] = 1
        out += held @ held.T
    return out


def _verify(threshold: int):
    def run(family: pa.Table) -> pa.Table:
        """Of one block, or two blocks, of a family: (digest, root, links) of the documents with links."""
        family = family.sort_by("digest")
        names = family.column("digest").to_pylist()
        n, first, alone, ell, copies, block = (family.column(c).to_numpy() for c in ("n", "first", "alone", "ell", "copies", "block"))
        codes = [np.frombuffer(x, np.uint64) for x in family.column("codes").to_pylist()]
        g = len(names)
        lo, hi = np.minimum.outer(n, n), np.maximum.outer(n, n)
        may = 100 * lo >= threshold * hi
        np.fill_diagonal(may, False)
        if family.column("bi")[0].as_py() != family.column("bj")[0].as_py():
            may &= block[:, None] != block[None, :]
        agreed = np.minimum.outer(ell, ell)
        for matches in np.unique(agreed[may]) if may.any() else ():
            met = _shared([c[: max(0, f + matches - 1 - a)] for c, f, a in zip(codes, first, alone)])
            may &= (agreed != matches) | (met >= matches)
        if may.any():
            both = _shared(codes)
            may &= 100 * both >= threshold * (n[:, None] + n[None, :] - both)
        links = (may * copies[None, :]).sum(axis=1)
        label = np.arange(g)
        while may.any():
            least = np.minimum(label, np.where(may, label[None, :], g).min(axis=1))
            least = np.minimum(least, least[least])
            if (least == label).all():
                break
            label = least
        rows = np.flatnonzero(links > 0)
        return pa.table([pa.array([names[i] for i in rows], pa.binary()), pa.array([names[label[i]] for i in rows], pa.binary()), pa.array(links[rows].astype(np.int64))], ["digest", "root", "links"])

    return run


def _verify_pairs(threshold: int):
    def run(batches):
        """The pairs (a, b) that link, of pairs with both sizes and shingles."""
        for batch in batches:
            rows = batch.to_pydict()
            keep = []
            for na, nb, a, b in zip(rows["na"], rows["nb"], rows["codes_a"], rows["codes_b"]):
                both = len(np.intersect1d(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), assume_unique=True))
                keep.append(100 * both >= threshold * (na + nb - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def candidate_pairs(narrow: DataFrame, threshold: int) -> DataFrame:
    """(a, b) of the documents that share as many prefix shingles as the smaller l asks, in the prefixes for that l.

    narrow: postings (u: shingle, v: digest, level: the least l whose prefix holds it, ell, n, root: the family or null), few of one shingle.
    """
    one = F.struct("v", "ell", "n", "root", "level")
    lists = narrow.groupBy("u").agg(F.array_sort(F.collect_list(one)).alias("list")).groupBy("list").agg(F.count("*").alias("times"))
    pairs = lists.select("list", "times", F.posexplode("list").alias("i", "x")).select("times", "x", F.explode(F.slice("list", F.col("i") + 2, F.size("list"))).alias("y"))
    ell, lo, hi = F.least("x.ell", "y.ell"), F.least("x.n", "y.n"), F.greatest("x.n", "y.n")
    apart = F.coalesce(F.col("x.root") != F.col("y.root"), F.lit(True))
    may = pairs.where(apart & (100 * lo >= threshold * hi) & (F.greatest("x.level", "y.level") <= ell))
    return may.groupBy(F.col("x.v").alias("a"), F.col("y.v").alias("b")).agg(F.sum("times").alias("shared"), F.first(ell).alias("ell")).where("shared >= ell").select("a", "b")


def blocks_of(family: DataFrame, total: int, threshold: int, block_docs: int, block_shingles: int) -> DataFrame:
    """(digest, root, block, bi, bj): a row for each pair of blocks that a document of a family (digest, root, n) is compared in."""
    width = float(np.log(1.0001 * 100 / threshold))
    sized = family.withColumn("size_class", F.floor(F.log("n") / width).cast("int"))  # sets that link are of one class or of neighbouring ones
    counts = sized.groupBy("root", "size_class").agg(F.count("*").alias("docs"), F.sum("n").alias("shingles"))
    many = F.greatest(F.ceil(F.col("docs") / block_docs), F.ceil(F.col("shingles") / block_shingles)).cast("int")
    roots = counts.groupBy("root").agg(F.sum("docs").alias("members"), F.sum("shingles").alias("shingles"), F.map_from_entries(F.collect_list(F.struct("size_class", many))).alias("blocks"))
    dealt = join_by_count(sized, roots, "root", total)
    small = (F.col("members") <= 2 * block_docs) & (F.col("shingles") <= 2 * block_shingles)
    number = lambda k, b: k.cast("long") * (1 << 32) + b
    own = number(F.col("size_class"), F.pmod(F.xxhash64("digest"), F.col("blocks")[F.col("size_class")]))
    near = F.filter(F.array(*(F.col("size_class") + k for k in (-1, 0, 1))), lambda k: F.map_contains_key("blocks", k))
    others = F.flatten(F.transform(near, lambda k: F.transform(F.sequence(F.lit(0), F.col("blocks")[k] - 1), lambda b: number(k, b))))
    dealt = dealt.select("digest", "root", F.when(small, F.lit(0).cast("long")).otherwise(own).alias("block"), F.when(small, F.array(F.lit(0).cast("long"))).otherwise(others).alias("others"))
    return dealt.withColumn("other", F.explode("others")).select("digest", "root", "block", F.least("block", "other").alias("bi"), F.greatest("block", "other").alias("bj"))


def similarity_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = 80, chunk_bytes: int = CHUNK_BYTES, bucket_shingles: int = BUCKET_SHINGLES,
    block_docs: int = BLOCK_DOCS, block_shingles: int = BLOCK_SHINGLES, wide: int = WIDE,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links) of every row of docs; see the module's text.

    component_id is the smallest doc_id that links reach, itself included; n_links counts the
    other rows that the row links with.
    """
    sigs = stored(signatures(docs, id_col, text_col), "signatures")
    nodes = stored(sigs.where("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies")), "nodes")
    size = docs.agg(F.sum(text_bytes(text_col)).alias("bytes")).first()["bytes"]
    seen = sigs.agg(F.sum("n_shingles").alias("n"), F.count("*").alias("rows")).first()
    buckets = parts(seen["n"], grown(bucket_shingles, size, GROWN_FROM))
    texts = _distinct_sets(docs, text_col, parts(size, grown(chunk_bytes, size, GROWN_FROM)))
    found = stored(candidates(texts, _frequencies(texts, buckets), buckets, threshold), "candidates")

    level = F.greatest(F.lit(1), F.col("alone") + F.col("i") + 2 - F.col("first"))
    postings = found.select("digest", "n", "ell", "first", "alone", F.posexplode("prefix").alias("i", "u")).select("u", F.col("digest").alias("v"), level.alias("level"), "ell", "n")
    total = found.agg(F.sum(F.size("prefix")).alias("n")).first()["n"] or 0
    met = stored(beside_least(postings, total).where("members > 1"), "postings")
    family = stored(connected(met.where(F.col("members") > wide).select(F.col("v").alias("u"), F.col("least").alias("v"))).withColumnRenamed("node", "digest"), "families")

    narrow = met.where(F.col("members") <= wide).join(family.withColumnRenamed("digest", "v"), "v", "left")
    codes = lambda side: found.select(F.col("digest").alias(side), F.col("n").alias(f"n{side}"), F.col("codes").alias(f"codes_{side}"))
    pairs = candidate_pairs(narrow, threshold).join(codes("a"), "a").join(codes("b"), "b").select("a", "b", "na", "nb", "codes_a", "codes_b")
    pairs = stored(pairs.mapInArrow(_verify_pairs(threshold), "a binary, b binary"), "pairs")

    members = found.select("digest", "n", "first", "alone", "ell", "codes").join(nodes.select("digest", "copies"), "digest")
    dealt = blocks_of(family.join(found.select("digest", "n"), "digest"), found.count(), threshold, block_docs, block_shingles)
    full = members.join(dealt, "digest").select("root", "bi", "bj", "block", "digest", "n", "first", "alone", "ell", "copies", "codes")
    blocks = stored(full.groupBy("root", "bi", "bj").applyInArrow(_verify(threshold), "digest binary, root binary, links long"), "linked")

    both = pairs.select(F.col("a").alias("digest"), F.col("b").alias("root")).unionByName(pairs.select(F.col("b").alias("digest"), F.col("a").alias("root")))
    from_pairs = both.join(nodes.select(F.col("digest").alias("root"), F.col("copies").alias("links")), "root").select("digest", "links")
    links = blocks.select("digest", "links").unionByName(from_pairs).groupBy("digest").agg(F.sum("links").alias("links"))
    roots = connected(blocks.select(F.col("digest").alias("u"), F.col("root").alias("v")).unionByName(pairs.select(F.col("a").alias("u"), F.col("b").alias("v")))).withColumnRenamed("node", "digest")
    linked = links.join(roots, "digest")
    members = nodes.join(linked, "digest", "left").where("copies > 1 or root is not null").select("digest", "least", "copies", F.coalesce("root", "digest").alias("root"), F.coalesce("links", F.lit(0)).alias("links"))
    members = stored(members, "members")
    components = members.groupBy("root").agg(F.min("least").alias("component"), F.count("*").alias("members"))
    classes = join_by_count(members, components, "root", seen["rows"]).select("digest", "component", (F.col("links") + F.col("copies") - 1).alias("links"), F.col("copies").alias("members"))
    joined = join_by_count(sigs, classes, "digest", seen["rows"], "left")
    return joined.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"), F.coalesce("links", F.lit(0)).alias("n_links"))


def one_of_each(docs: DataFrame, threshold: int = 80) -> DataFrame:
    """The rows of docs, with all their columns, of which each class keeps that of the smallest doc_id; of equal rows one stays."""
    classes = similarity_classes(docs, threshold=threshold)
    kept = classes.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("__kept")).distinct()
    rows = docs.join(kept, docs["doc_id"].eqNullSafe(kept["__kept"]), "left_semi")
    return rows.withColumn("__text", F.xxhash64("text")).dropDuplicates(["doc_id", "__text"]).drop("__text")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity_classes(table(spark, sf_dir, "documents"))


#: The same rows from all pairs that share a shingle, and the closure of links; for small tables.
SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, list_aggregate(w[i:i + 4], 'string_agg', ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b USING (s) WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
sides AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT b, c FROM reach JOIN sides ON doc_id = a WHERE c < b)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(doc_id, c) AS component_id, coalesce(k, 0)::BIGINT AS n_links
FROM (SELECT doc_id, min(c) AS c FROM reach GROUP BY doc_id) LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a AS doc_id, count(*) AS k FROM sides GROUP BY a) USING (doc_id)
"""
