"""Jaccard join of word shingles by parity sketches.

A text's set of shingles is hashed into a bit sketch: a shingle flips one bit, its segment from the high half of its hash
and its place among the segment's 2^32 bits from the low half. The Hamming distance of two sketches is at most the
symmetric difference of the sets, and two sets of Jaccard similarity s, the larger of size t, differ in at most
d = 2t(1-s)/(1+s) shingles. With d + 1 + k segments, such sets agree in at least k + 1 of them; so each text may leave out
its k emptiest segments (those that unrelated texts share by chance) and one equal segment still remains. Segment counts
are fixed for bands of size; a text is filed in the band of its own size and, if a larger partner could lie in the
next, there too. Segments are kept sparse, as the exclusive-or of their places.

Equal segments gather texts in buckets. Texts with one set are one class before that. A bucket's members are first
compared with the one that meets most others; what that verifies is joined into components. Pairs of one
bucket that are not in one component after that are compared by dense sketches, block against block: first each member
gives its nearest one only, which joins most of a crowded family, then all that is left is listed, in the buckets where any was left. Before any text is
read, a pair's Hamming distance must leave the link possible; every verdict is an exact count on the shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.components import components
from lakemart.llm.textops import lower_ascii, mix, release_memory, text_bytes, word_hashes, words
from lakemart.workspace import durable, durable_observed

ROWS_BYTES = 1 << 20
GROUP_KEYS = 1 << 20
BLOCK = 1024
_STEP = np.uint64(0xA0761D6478BD642F)


def shingle_sets(column: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For runs of rows: the first row's number, the distinct shingle hashes of all its rows (ascending for each row)
    and how many each row has. A text of fewer than ``k`` words has its whole sequence as one shingle."""
    data, offsets = text_bytes(column)
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + ROWS_BYTES, "right")) - 1)
        part, bounds = lower_ascii(data[offsets[at] : offsets[to]]), offsets[at : to + 1] - offsets[at]
        starts, ends, first = words(part, bounds)
        hashes = word_hashes(part, starts, ends)
        size = np.diff(first)
        usual = np.maximum(size - k + 1, (size > 0).astype(np.int64))
        chain = hashes.copy()
        for j in range(1, k):
            chain[: len(hashes) - j] = mix(chain[: len(hashes) - j] * _STEP + hashes[j:]) if len(hashes) > j else chain[:0]
        sets = []
        for f, words_here, shingles in zip(first[:-1].tolist(), size.tolist(), usual.tolist()):
            if words_here >= k:
                own = chain[f : f + shingles]
                own.sort()
                keep = np.empty(len(own), bool)
                keep[0] = True
                np.not_equal(own[1:], own[:-1], out=keep[1:])
                sets.append(own if keep.all() else own[keep])
            elif words_here:
                whole = np.uint64(words_here)
                for h in hashes[f : f + words_here]:
                    whole = mix(np.array([whole], np.uint64) * _STEP + h)[0]
                sets.append(np.array([whole], np.uint64))
            else:
                sets.append(hashes[:0])
        yield at, np.concatenate(sets), np.fromiter(map(len, sets), np.int64, len(sets))
        at = to


def signatures(sets: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each row's whole set, as signed integers; of an empty set 0."""
    out = np.zeros(len(counts), np.uint64)
    full = counts > 0
    starts = (np.cumsum(counts) - counts)[full]
    if len(starts):
        out[full] = mix(np.add.reduceat(mix(sets ^ _STEP), starts) + counts[full].astype(np.uint64))
    return out.view(np.int64)


class Bands:
    """Size bands and their segments. ``percent`` is the similarity in percent."""

    def __init__(self, percent: int, ratio: float = 1.6, largest: int = 1 << 40):
        tops = [4]
        while tops[-1] < largest:
            tops.append(int(tops[-1] * ratio) + 1)
        self.tops, self.percent = np.array(tops, np.int64), percent
        differ = 2 * self.tops * (100 - percent) // (100 + percent)
        self.spare = 2 + (differ + 1) // 10
        self.segments = np.where(differ > 0, differ + 1 + self.spare, 0)

    def of(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.tops, sizes)

    def keys(self, sets: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(keys, rows)``: the keys under which each row is filed."""
        keys, rows = [], []
        own, reach = self.of(counts), self.of(counts * 100 // self.percent)
        for more in range(int((reach - own).max(initial=0)) + 1):
            band = own + more
            use = np.flatnonzero((counts > 0) & (band <= reach) & (self.segments[band] > 0))
            if not len(use):
                continue
            member = np.zeros(len(counts), bool)
            member[use] = True
            u = sets[np.repeat(member, counts)]
            m, size = self.segments[band[use]], counts[use]
            base = np.cumsum(m) - m
            row = np.repeat(np.arange(len(use)), size)
            place = base[row] + (((u >> np.uint64(32)) * m[row].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
            filled = np.bincount(place, minlength=int(m.sum()))
            change = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
            state = np.zeros(len(filled), np.uint64)
            state[place[change]] = np.bitwise_xor.reduceat(mix(u & np.uint64(0xFFFFFFFF)), change)
            holder = np.repeat(np.arange(len(use)), m)
            order = np.sort(holder * (np.int64(1) << 32) + np.minimum(filled, (1 << 32) - 1))
            least = order[base + self.spare[band[use]]] & 0xFFFFFFFF
            chosen = np.flatnonzero(filled >= least[holder])
            where = holder[chosen]
            label = (band[use][where] * (1 << 40) + chosen - base[where]).astype(np.uint64)
            keys.append(mix(mix(state[chosen] + filled[chosen].astype(np.uint64)) ^ mix(label)))
            rows.append(use[where])
        if not keys:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        return np.concatenate(keys), np.concatenate(rows)


def _classes(docs: DataFrame, shingle: int) -> tuple[DataFrame, dict]:
    """``(doc_id, key, sig, n)`` for every row, written; ``key`` is a hash of the text as it stands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, sets, counts in shingle_sets(batch.column(1), shingle):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(counts)), batch.column(2).slice(at, len(counts)), pa.array(signatures(sets, counts)), pa.array(counts)],
                    ["doc_id", "key", "sig", "n"],
                )
        release_memory()

    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("key"))
    return durable_observed(keyed.mapInArrow(run, "doc_id bigint, key bigint, sig bigint, n bigint"), "classes", F.sum("n").alias("shingles"))


def _least_row(*more: str) -> Column:
    """The least of a group's rows: by id, null ids last, then by ``more``."""
    return F.min(F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", *more))


def class_texts(docs: DataFrame, classes: DataFrame, involved: DataFrame) -> DataFrame:
    """``(sig, text)``: one row for each signature of ``involved``.

    A row is fetched by its id and the hash of its text, so neither rows without id nor the texts of one id meet each other.
    """
    reps = classes.groupBy("sig").agg(_least_row("key").alias("rep")).join(involved, "sig").select("sig", "rep.doc_id", "rep.key")
    here = docs.select("doc_id", "text", F.xxhash64("text").alias("key"))
    found = here.join(reps, here["doc_id"].eqNullSafe(reps["doc_id"]) & (here["key"] == reps["key"]))
    return found.select("sig", "text").dropDuplicates(["sig"])


def _buckets(docs: DataFrame, shingle: int, bands: Bands, groups: int) -> DataFrame:
    """``(center, members)``: signatures that share a segment, each list once for each group of keys."""

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # a set is filed once for each partition, however many copies it holds
        keys, sigs, held = [], [], 0

        def deal() -> pa.RecordBatch:
            k, s = np.concatenate(keys), np.concatenate(sigs)
            group = (k % np.uint64(groups)).astype(np.int64)
            order = np.argsort(group, kind="stable")
            present, starts = np.unique(group[order], return_index=True)
            k, s, ends = k[order].tobytes(), s[order].tobytes(), [*starts[1:].tolist(), len(order)]
            cut = [slice(8 * a, 8 * b) for a, b in zip(starts.tolist(), ends)]
            return pa.RecordBatch.from_arrays(
                [pa.array(present.astype(np.int32)), pa.array([k[c] for c in cut], pa.binary()), pa.array([s[c] for c in cut], pa.binary())],
                ["p", "keys", "sigs"],
            )

        for batch in batches:
            for _, sets, counts in shingle_sets(batch.column(1), shingle):
                sig = signatures(sets, counts)
                new = np.fromiter((c > 0 and x not in seen and not seen.add(x) for x, c in zip(sig.tolist(), counts.tolist())), bool, len(counts))
                k, rows = bands.keys(sets[np.repeat(new, counts)], counts[new])
                keys.append(k)
                sigs.append(sig[new][rows])
                held += len(k)
                if held > 1 << 20:
                    yield deal()
                    keys, sigs, held = [], [], 0
        if held:
            yield deal()
        keys, sigs = [], []
        seen.clear()
        release_memory()

    def meet(table: pa.Table) -> pa.Table:
        k = np.frombuffer(b"".join(table["keys"].to_pylist()), np.uint64)
        s = np.frombuffer(b"".join(table["sigs"].to_pylist()), np.int64)
        order = np.lexsort((s, k))
        k, s = k[order], s[order]
        fresh = np.concatenate([[True], (k[1:] != k[:-1]) | (s[1:] != s[:-1])])
        k, s = k[fresh], s[fresh]
        starts = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
        sizes = np.diff(np.append(starts, len(k)))
        s = s[np.repeat(sizes > 1, sizes)]
        sizes = sizes[sizes > 1]
        if not len(sizes):
            return pa.table({"center": pa.array([], pa.int64()), "members": pa.array([], pa.list_(pa.int64()))})
        starts = np.cumsum(sizes) - sizes
        kinds, back = np.unique(s, return_inverse=True)
        met = np.bincount(back, weights=np.repeat(sizes - 1, sizes))[back]
        same = mix(np.add.reduceat(mix(s.view(np.uint64)), starts) + sizes.astype(np.uint64))
        _, once = np.unique(same, return_index=True)
        best = np.lexsort((s, -met, np.repeat(np.arange(len(sizes)), sizes)))[starts]
        lists = [s[starts[i] : starts[i] + sizes[i]] for i in once]
        found = pa.table({"center": pa.array(s[best][once]), "members": pa.array(lists, pa.list_(pa.int64()))})
        del k, s, lists, order, fresh, kinds, back, met
        release_memory()
        return found

    filed = docs.mapInArrow(file, "p int, keys binary, sigs binary")
    return durable(filed.groupBy("p").applyInArrow(meet, "center bigint, members array<bigint>"), "buckets")


def _verified(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int, label: str) -> DataFrame:
    """The pairs ``(a, b)`` of signatures whose sets are similar enough, written."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_sig, last = None, None
        for batch in batches:
            a, b, left, right = (batch.column(i) for i in range(4))
            a_sigs, keep, at = a.to_numpy(), [], 0
            for row, sets, counts in shingle_sets(right, shingle):
                ends = np.cumsum(counts)
                for i, (e, c) in enumerate(zip(ends.tolist(), counts.tolist())):
                    if a_sigs[row + i] != last_sig:
                        last_sig = a_sigs[row + i]
                        last = next(shingle_sets(left.slice(row + i, 1), shingle))[1]
                    other = sets[e - c : e]
                    small, large = (last, other) if len(last) <= len(other) else (other, last)
                    if 100 * len(small) < percent * len(large):
                        continue
                    common = int((large[np.minimum(np.searchsorted(large, small), len(large) - 1)] == small).sum())
                    if 100 * common >= percent * (len(small) + len(large) - common):
                        keep.append(row + i)
            take = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([a.take(take), b.take(take)], ["a", "b"])
        release_memory()

    with_b = pairs.join(texts.select(F.col("sig").alias("b"), F.col("text").alias("text_b")), "b")
    both = with_b.join(texts.select(F.col("sig").alias("a"), F.col("text").alias("text_a")), "a")
    return durable(both.select("a", "b", "text_a", "text_b").mapInArrow(count, "a bigint, b bigint"), label)


def similar_classes(docs: DataFrame, shingle: int = 5, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """``(classes, labels)``: ``(doc_id, key, sig, n)`` for every row of ``docs`` (``doc_id``, ``text``), and
    ``(node, component)`` over the signatures that are linked with a different set."""
    bands = Bands(percent)
    classes, seen = _classes(docs, shingle)
    groups = max(8, (seen["shingles"] or 0) * 2 // 5 // GROUP_KEYS * 2)
    buckets = _buckets(docs, shingle, bands, groups)

    stars = buckets.select(F.col("center").alias("a"), F.explode("members").alias("b")).where("a != b")
    stars = durable(stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "stars")
    involved = stars.select(F.col("a").alias("sig")).union(stars.select("b")).distinct()

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, sets, counts in shingle_sets(batch.column(1), shingle):
                ends = np.cumsum(counts)
                bits = [parity_sketch(sets[e - c : e]) for e, c in zip(ends.tolist(), counts.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, len(counts)), batch.column(1).slice(row, len(counts)), pa.array(counts), pa.array(bits, pa.binary())],
                    ["sig", "text", "n", "bits"],
                )
        release_memory()

    found = class_texts(docs, classes, involved)
    texts = durable(found.mapInArrow(sketch, "sig bigint, text string, n bigint, bits binary"), "class-texts")

    side = lambda c: texts.select(F.col("sig").alias(c), F.col("n").alias(f"n_{c}"), F.col("bits").alias(f"bits_{c}"))
    sketched = stars.join(side("b"), "b").join(side("a"), "a").select("a", "b", "n_a", "n_b", "bits_a", "bits_b")

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4), batch.column(5))
            keep = pa.array([i for i, (x, y, p, q) in enumerate(sizes) if may_link(x, y, p.as_py(), q.as_py(), percent)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(keep), batch.column(1).take(keep)], ["a", "b"])

    close = durable(sketched.mapInArrow(near, "a bigint, b bigint"), "close-stars")
    linked = _verified(close, texts, shingle, percent, "star-links")
    places = buckets.select(F.xxhash64("members").alias("bucket"), "members").dropDuplicates(["bucket"])
    for nearest in (True, False):
        near_pairs = durable(_apart(places, components(linked), texts, percent, nearest), "close-pairs")
        linked = linked.unionByName(_verified(near_pairs.select("a", "b").distinct(), texts, shingle, percent, "more-links"))
        places = places.join(near_pairs.where("more").select("bucket").distinct(), "bucket", "left_semi")
    return classes, components(linked)


def parity_sketch(shingles: np.ndarray) -> bytes:
    """One bit flipped for each shingle, in a power of two of bits, one to two times as many as shingles.

    That is up to two bits for each: it is sent once for every bucket and star of a text. Unrelated sets do not pass, sets that
    differ in a third more than a link allows rarely do; those are counted exactly in vain.
    """
    size = 1 << max(6, len(shingles).bit_length())
    flips = np.bincount((mix(shingles ^ _STEP) & np.uint64(size - 1)).astype(np.int64), minlength=size)
    return np.packbits((flips & 1).astype(np.uint8)).tobytes()


def _folded(bits: np.ndarray, words: int) -> np.ndarray:
    """Sketches (rows of 64-bit words) folded to fewer words: the sketches they would have had at that size."""
    while bits.shape[1] > words:
        half = bits.shape[1] // 2
        bits = bits[:, :half] ^ bits[:, half:]
    return bits


def may_link(n_a: int, n_b: int, bits_a: bytes, bits_b: bytes, percent: int) -> bool:
    """Whether two sketches leave it open that the sets are similar enough."""
    if 100 * min(n_a, n_b) < percent * max(n_a, n_b):
        return False
    a, b = (np.frombuffer(x, np.uint64)[None] for x in (bits_a, bits_b))
    words = min(a.shape[1], b.shape[1])
    return int(np.bitwise_count(_folded(a, words) ^ _folded(b, words)).sum()) * (100 + percent) <= (100 - percent) * (n_a + n_b)


def _apart(places: DataFrame, labels: DataFrame, texts: DataFrame, percent: int, nearest: bool) -> DataFrame:
    """``(a, b, bucket, more)``: pairs of one bucket that no link joins yet and whose sketches are close enough, or of these
    each member's ``nearest`` only; ``more`` tells that a pair was left out for a nearer one. Large buckets are dealt to blocks,
    and a bucket looks at a pair in one block. A bucket of two has met its only pair as a star."""
    places = places.select("bucket", F.explode("members").alias("node")).join(labels, "node", "left")
    placed = durable(places.select("bucket", "node", F.coalesce("component", "node").alias("own")), "bucket-places")
    open_ = placed.groupBy("bucket").agg(F.min("own").alias("lo"), F.max("own").alias("hi"), F.count("*").alias("size")).where("lo != hi and size > 2")
    open_ = durable(open_.select("bucket", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")), "open-buckets")
    members = durable(placed.join(open_, "bucket").withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int")), "bucket-members")
    members = members.join(texts.select(F.col("sig").alias("node"), "n", "bits"), "node")
    own = ("node", "own", "n", "bits")
    sides = members.select("bucket", "block", "blocks", *own, F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    sides = sides.select(
        "bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), (F.col("block") <= F.col("other")).alias("left"), *own
    )

    def compare(table: pa.Table) -> pa.Table:
        node, label, n = (table[c].to_numpy() for c in ("node", "own", "n"))
        left = table["left"].to_numpy(zero_copy_only=False)
        bits = [np.frombuffer(x, np.uint64) for x in table["bits"].to_pylist()]
        words = np.array([len(x) for x in bits])
        rows, cols = np.flatnonzero(left), np.flatnonzero(~left) if not left.all() else np.flatnonzero(left)
        out = []
        for wa in np.unique(words[rows]):
            for wb in np.unique(words[cols]):
                a, b, w = rows[words[rows] == wa], cols[words[cols] == wb], min(wa, wb)
                xa, xb = (_folded(np.stack([bits[k] for k in side]), w) for side in (a, b))
                for i, x in zip(a.tolist(), xa):
                    fit = (label[b] != label[i]) & (100 * np.minimum(n[b], n[i]) >= percent * np.maximum(n[b], n[i]))
                    if left.all():
                        fit &= node[b] > node[i]
                    some = np.flatnonzero(fit)
                    if len(some):
                        gap = np.bitwise_count(xb[some] ^ x).sum(1, dtype=np.int64)
                        near = gap * (100 + percent) <= (100 - percent) * (n[b[some]] + n[i])
                        some, gap = some[near], gap[near]
                        more = nearest and len(gap) > 1
                        if more:
                            some = some[[gap.argmin()]]
                        out += [(node[i], node[k], more) for k in b[some]]
        pairs = np.array(out, np.int64).reshape(-1, 3)
        return pa.table({
            "a": np.minimum(pairs[:, 0], pairs[:, 1]), "b": np.maximum(pairs[:, 0], pairs[:, 1]),
            "bucket": np.full(len(pairs), table["bucket"][0].as_py()), "more": pairs[:, 2] > 0,
        })

    return sides.groupBy("bucket", "i", "j").applyInArrow(compare, "a bigint, b bigint, bucket bigint, more boolean")


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every row.

    Words are runs of anything but ASCII white space, A-Z lower-cased; a set holds the distinct runs of ``shingle`` words,
    or a shorter text's whole sequence. Two rows link when 100 * intersection >= ``percent`` * union. ``component_id`` is the
    smallest id reachable by links, the row's own included (null ids are passed over unless all are null). Texts
    without words and null texts have no shingle and link with nothing. Repeated rows give repeated results, an empty
    table none; other columns are ignored. A signature of 64 bits stands for a set, and one for a shingle.
    """
    source = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    classes, own = _grouped(source, shingle, percent)
    least = durable(own.groupBy("component").agg(F.min("first.doc_id").alias("component_id")), "component-ids")
    final = durable(own.join(least, "component").select("sig", "component_id"), "class-ids")
    wordless = classes.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return classes.where("n > 0").join(final, "sig").select("doc_id", F.col("n").alias("n_shingles"), "component_id").unionByName(wordless)


def _grouped(source: DataFrame, shingle: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """``(classes, own)``: the rows of ``similar_classes``, and ``(sig, first, component)`` for every set that is not empty;
    ``first`` is the least row that has it."""
    classes, labels = similar_classes(source, shingle, percent)
    own = classes.where("n > 0").groupBy("sig").agg(_least_row("key").alias("first")).join(labels, F.col("sig") == F.col("node"), "left")
    return classes, durable(own.select("sig", "first", F.coalesce("component", "sig").alias("component")), "class-components")


def one_row_of_each_group(docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with exactly one row of each component of ``near_duplicates``.

    That is the row of the least id, null ids last; of one id's texts in a component the one of the least signature, then
    of the least hash. So a row without id goes if anything like it has an id, and one row stays of a group without any. A
    repeated row (same id, same text) is one document and stays once, with the least of its other columns. Texts without
    words are in no group: each id's text stays once, and rows without both id and words all stay.
    """
    source = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    classes, own = _grouped(source, shingle, percent)
    least = F.min(F.struct("first.absent", "first.doc_id", "sig", "first.key"))
    winners = own.groupBy("component").agg(least.alias("row")).select("row.doc_id", "row.key")
    wordless = classes.where("n = 0 and doc_id is not null").select("doc_id", "key").distinct()
    spot = [F.coalesce("__id", F.lit(0)).alias("__place"), F.col("__id").isNull().alias("__absent"), "__key"]
    chosen = durable(winners.unionByName(wordless), "chosen-rows").select(F.col("doc_id").alias("__id"), F.col("key").alias("__key")).select(*spot)

    keyed = docs.withColumns({"__id": F.col(id_col).cast("bigint"), "__key": F.xxhash64(F.col(text_col).cast("string"))})
    nameless = F.col("__id").isNull() & ~F.coalesce(F.col(text_col).cast("string").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    row = F.struct(*[F.col(c) for c in docs.columns if c != text_col], F.col(text_col))
    # Repeated rows meet within each task before the texts move; the join finds the texts where they lie.
    single = keyed.where(~nameless).groupBy(*spot).agg(F.min(row).alias("__row"))
    kept = single.join(chosen, ["__place", "__absent", "__key"], "left_semi").select(*(F.col("__row")[c].alias(c) for c in docs.columns))
    return kept.unionByName(keyed.where(nameless).select(*docs.columns))
