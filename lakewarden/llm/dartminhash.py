"""MinHash near-dedup with DartMinHash signatures.

A text is a weighted set: the elements are its shingles of five words, the weight is how often a
shingle occurs. Similarity is the weighted Jaccard similarity (for texts without a repeated
shingle, the plain one). Darts fall into the region of every element, one strip per unit of weight,
as a Poisson process over rank whose gaps are hashes of the element, so equal elements get equal
darts in every text. Darts below a rank of ``t / weight`` are kept, about ``t`` per text whatever its
length; each is thrown at one of k coordinates, and the earliest per coordinate is the signature.
The rank limit is doubled for texts with an empty coordinate.

Two signatures agree at a coordinate with a probability equal to the similarity. Texts that agree in
all ROWS coordinates of one of BANDS bands share a bucket (a pair at 0.8 is missed with a
probability below 1e-3). Links are found in rounds, never by all pairs of a bucket:

1. every member is linked to the bucket's smallest member;
2. buckets whose members are still in different components: links to the next members in the order
   of the nodes too (a random one), which covers all pairs of a bucket up to NEIGHBOURS + 1 members;
3. all members of larger buckets that are still divided: an exact join. Two texts that are alike
   have one of the rarest elements of each in common, so texts meet that share such an element
   and are not all of one component. They are compared in blocks by products of their element
   matrices; of a block only links between different components come out, never its pairs.

So two alike texts are in one class if they share a bucket, whatever its size.

Every link is checked exactly on the element sets. Classes are connected components of links.

Nulls and texts without a word are one text without elements, so they are exact copies of each
other. Texts with equal lower-case words are copies whatever their white space. Texts of one to
four words are one shingle. Rows that repeat a ``doc_id`` are judged each by its text. A null
``doc_id`` is an ordinary value that comes before all others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from lakewarden.llm.components import components
from lakewarden.llm.flat import Flat, mix, occurrence, slices, unit
from lakewarden.llm.lean import give_back, lean
from lakewarden.llm.scratch import Scratch

SHINGLE = 5
K = 128
ROWS, BANDS = 8, 48
NEIGHBOURS = 3
PIECE = 4096          # members of a bucket that are put in order together
SLOTS = 1 << 18       # counters of elements; texts that share one only lose selectivity
BLOCK, STRIP, COLUMNS = 1 << 18, 256, 1024  # elements of a block; rows and elements multiplied at once
LEAST = 32            # elements a text counts for at least, so a block has at most BLOCK / LEAST texts
SLACK = 0.17          # a link is checked when the signatures agree in this much less than asked

_U = np.uint64
_SALT = mix(np.arange(1, 4096, dtype=_U) * _U(0x9E3779B97F4A7C15))


def elements(flat: Flat) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of (shingle, occurrence) with their text, in text order, and two hashes of each
    text's word sequence."""
    starts, ends = flat.words()
    word = flat.hashes(starts, ends)
    begin = flat.bounds(starts)
    n = np.diff(begin)
    place = np.arange(len(word)) - np.repeat(begin[:-1], n)
    keys = []
    for salt in (0, 1):
        mixed = mix(word + mix(place.astype(_U) + _SALT[salt]))
        total = np.concatenate(([_U(0)], np.cumsum(mixed, dtype=_U)))
        keys.append(mix(total[begin[1:]] - total[begin[:-1]] + n.astype(_U)))
    doc = np.repeat(np.arange(flat.docs), n)
    full = place + SHINGLE <= n[doc]
    at = np.flatnonzero(full)
    shingle = np.zeros(len(at), _U)
    for j in range(SHINGLE):
        shingle += word[at + j] * (_SALT[10 + j] | _U(1))
    short = np.flatnonzero((n > 0) & (n < SHINGLE))
    owner = np.concatenate((doc[at], short))
    value = np.concatenate((mix(shingle), keys[0][short]))
    order, nth, _ = occurrence(owner, value)
    return mix(value[order] + nth.astype(_U) * _SALT[20]), owner[order], keys[0], keys[1]


def signatures(element: np.ndarray, owner: np.ndarray, docs: int, k: int = K) -> np.ndarray:
    """Signature of every text, shape (docs, k): 16 bits of the earliest dart per coordinate.
    Rows of texts without elements stay at the largest value."""
    out = np.full(docs * k, np.iinfo(_U).max, _U)
    weight = np.bincount(owner, minlength=docs)
    limit = (k * np.log(k) + 2 * k) / np.maximum(weight, 1)
    todo = weight > 0
    while todo.any():
        cell = np.flatnonzero(todo[owner])
        seed, of = element[cell], owner[cell]
        rank = np.zeros(len(cell))
        done, width = 0, 1
        while len(seed):
            nth = np.arange(done, done + width, dtype=_U) * _SALT[30]
            dart = mix(seed[:, None] + nth)
            ranks = rank[:, None] + np.cumsum(-np.log(unit(dart)), axis=1)
            row, col = np.nonzero(ranks <= limit[of][:, None])
            ident = mix(dart[row, col] ^ _SALT[31])
            early = ranks[row, col].astype(np.float32).view(np.uint32).astype(_U)
            slot = of[row] * k + (ident >> _U(40)).astype(np.int64) % k
            np.minimum.at(out, slot, (early << _U(32)) | (ident & _U(0xFFFFFFFF)))
            on = ranks[:, -1] <= limit[of]
            seed, of, rank = seed[on], of[on], ranks[on, -1]
            done, width = done + width, min(64, width * 2)
        todo &= (out.reshape(docs, k) == np.iinfo(_U).max).any(axis=1)
        limit = limit * 2
    return (out.reshape(docs, k) & _U(0xFFFF)).astype(np.uint16)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _node_of(lower: Column) -> Column:
    """The node of a lower-case text, as ``_sign`` gives it."""
    @F.pandas_udf("long")
    def node(texts):
        import pandas as pd

        keys = [elements(flat)[2].view(np.int64) for _, flat in slices(pa.array(texts, pa.string()), rows=512)]
        give_back()
        return pd.Series(np.concatenate(keys) if keys else np.zeros(0, np.int64))

    return node(lower)


def _fixed(matrix: np.ndarray) -> pa.Array:
    """A binary column with one row of the matrix in each value."""
    wide = matrix.shape[1] * matrix.itemsize
    places = np.arange(len(matrix) + 1, dtype=np.int32) * wide
    return pa.Array.from_buffers(pa.binary(), len(matrix), [
        None, pa.py_buffer(places.tobytes()), pa.py_buffer(np.ascontiguousarray(matrix).tobytes())])


def _matrix(column: pa.Array, kind: type = np.uint16) -> np.ndarray:
    if len(column) == 0:
        return np.zeros((0, K), kind)
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, flat in slices(batch.column(1), rows=512):
            element, owner, key, _ = elements(flat)
            sig = signatures(element, owner, flat.docs)
            begin = np.searchsorted(owner, np.arange(flat.docs + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(
                pa.array(begin), pa.array(element.astype(np.uint32).view(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(low, flat.docs), _signed(key), _fixed(sig),
                 _fixed(sig.astype(np.uint8)), lists],
                ["doc_id", "node", "sig", "tiny", "elements"])


def _subsets(rows: int, count: int, seed: int) -> np.ndarray:
    """``count`` sets of ``rows`` coordinates; no coordinate twice before all were used."""
    rng, out = np.random.RandomState(seed), []
    while len(out) < count:
        order = rng.permutation(K)
        out += [order[i:i + rows] for i in range(0, K - rows + 1, rows)]
    return np.array(out[:count])


def _combined(sig: np.ndarray, subsets: np.ndarray) -> np.ndarray:
    """One hash per text and subset of coordinates."""
    out = np.zeros((len(sig), len(subsets)), _U)
    for j in range(subsets.shape[1]):
        out += sig[:, subsets[:, j]].astype(_U) * (_SALT[40 + j] | _U(1))
    return mix(out + _SALT[100:100 + len(subsets)])


def _band(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    subsets = _subsets(ROWS, BANDS, 1)
    for batch in batches:
        sig = _matrix(batch.column(1))
        bucket = _combined(sig, subsets).reshape(-1)
        yield pa.RecordBatch.from_arrays(
            [_signed(bucket), batch.column(0).take(pa.array(np.repeat(np.arange(len(sig)), BANDS)))],
            ["bucket", "node"])


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many elements fall into each slot."""
    total = np.zeros(SLOTS, np.int64)
    for batch in batches:
        total += np.bincount(_slot(batch.column(0).flatten().to_numpy()), minlength=SLOTS)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["slot", "n"])


def _slot(element: np.ndarray) -> np.ndarray:
    return element.astype(np.int64) & (SLOTS - 1)


def _prefixes(counts, similarity: float):
    """The rarest elements of every text, as many as one that is alike must share at least one of.
    Those no other text can have are left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = counts.value
        for batch in batches:
            tokens, sizes = [], []
            for own in batch.column(2):
                value = own.values.to_numpy()
                sizes.append(len(value))
                value = np.unique(value)
                n = seen[_slot(value)]
                order = np.lexsort((value, n))[:max(0, len(value) - int(np.ceil(similarity * sizes[-1] - 1e-6)) + 1)]
                tokens.append(value[order][n[order] > 1])
            rows = pa.array(np.repeat(np.arange(len(sizes)), [len(t) for t in tokens]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([*tokens, np.zeros(0, np.int32)]).astype(np.int32)),
                 batch.column(0).take(rows), batch.column(1).take(rows),
                 pa.array(np.array(sizes, np.int32)).take(rows)], ["token", "node", "root", "size"])
    return run


def _compared(similarity: float):
    """Links of a block or between two blocks, at most one less than they have components."""
    def run(rows: pa.Table) -> pa.Table:
        block, x, y = (rows.column(c).to_numpy() for c in ("block", "x", "y"))
        node, root = rows.column("node").to_numpy(), rows.column("root").to_numpy()
        lists = rows.column("elements").combine_chunks()
        size = lists.value_lengths().to_numpy()
        pair = np.unique((np.repeat(np.arange(len(size)), size).astype(_U) << _U(32))
                         | lists.flatten().to_numpy().view(np.uint32).astype(_U))
        owner = (pair >> _U(32)).astype(np.int64)
        _, code, often = np.unique(pair & _U(0xFFFFFFFF), return_inverse=True, return_counts=True)
        owner, code = owner[often[code] > 1], code[often[code] > 1]
        left, right = np.flatnonzero(block == x[0]), np.flatnonzero(block == y[0])
        at = np.full(len(node), -1)
        at[right] = np.arange(len(right))
        there = at[owner] >= 0
        r_row, r_code = at[owner[there]], code[there]
        up: dict[int, int] = {}

        def top(v: int) -> int:
            while (w := up.get(v, v)) != v:
                up[v] = up.get(w, w)
                v = w
            return v

        out = []
        for low in range(0, len(left), STRIP):
            strip = left[low:low + STRIP]
            at = np.full(len(node), -1)
            at[strip] = np.arange(len(strip))
            here = at[owner] >= 0
            l_row, l_code = at[owner[here]], code[here]
            column = np.full(len(often), -1)
            known = np.intersect1d(l_code, r_code)
            column[known] = np.arange(len(known))
            both = np.zeros((len(strip), len(right)), np.float32)
            for c in range(0, len(known), COLUMNS):
                sides = []
                for row, col, n in ((l_row, column[l_code], len(strip)), (r_row, column[r_code], len(right))):
                    inside = (col >= c) & (col < c + COLUMNS)
                    side = np.zeros((n, min(COLUMNS, len(known) - c)), np.float32)
                    side[row[inside], col[inside] - c] = 1
                    sides.append(side)
                both += sides[0] @ sides[1].T
            both = both.astype(np.float64)
            alike = both >= similarity * (size[strip][:, None] + size[right][None, :] - both)
            i, j = np.nonzero(alike & (root[strip][:, None] != root[right][None, :]))
            a, b = strip[i], right[j]
            _, first = np.unique(np.stack((root[a], root[b])), axis=1, return_index=True)
            for k in first.tolist():
                p, q = top(int(root[a[k]])), top(int(root[b[k]]))
                if p != q:
                    up[max(p, q)] = min(p, q)
                    out.append((node[a[k]], node[b[k]]))
        found = np.array(out, np.int64).reshape(-1, 2)
        return pa.table({"a": found.min(axis=1, initial=np.iinfo(np.int64).max),
                         "b": found.max(axis=1, initial=np.iinfo(np.int64).min)})
    return run


def _agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        same = (_matrix(batch.column(2), np.uint8) == _matrix(batch.column(3), np.uint8)).mean(axis=1)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(same)], ["a", "b", "agreement"])


def _divided(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """The members of buckets that hold several components, with the size and the smallest member
    of the bucket. Members of one bucket are counted with map-side aggregation."""
    if labels is None:
        here = members.withColumn("comp", F.col("node"))
    else:
        here = members.join(labels, "node", "left") \
            .select("bucket", "node", F.coalesce("root", "node").alias("comp"))
    sizes = here.groupBy("bucket").agg(
        F.count("*").alias("n"), F.min("node").alias("lead"), F.min("comp").alias("low"),
        F.max("comp").alias("high"),
    ).filter("low <> high")
    return here.join(sizes.select("bucket", "n", "lead"), "bucket")


def _links(divided: DataFrame, neighbours: int) -> DataFrame:
    """Candidate links (a < b) between members of divided buckets. A bucket of more than PIECE members
    is put in order in pieces, so no task gets a whole large bucket."""
    stars = divided.filter("node <> lead").select(F.col("lead").alias("a"), F.col("node").alias("b"))
    if not neighbours:
        return stars.distinct()
    piece = Window.partitionBy("bucket", F.expr(f"pmod(xxhash64(node), ceil(n / {PIECE}))")) \
        .orderBy("node")
    after = [F.lead(F.struct("node", "comp"), j).over(piece) for j in range(1, neighbours + 1)]
    near = divided.select("node", "comp", F.array(*after).alias("after")) \
        .select("node", "comp", F.explode("after").alias("other")) \
        .filter("other.comp <> comp") \
        .select(F.least("node", "other.node").alias("a"), F.greatest("node", "other.node").alias("b"))
    return stars.union(near).distinct()


def _with_roots(pairs: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Pairs (a, b) with the components (ra, rb) of their ends; a node without a label is its own."""
    if labels is None:
        return pairs.withColumns({"ra": F.col("a"), "rb": F.col("b")})
    for end in ("a", "b"):
        pairs = pairs.join(labels.select(F.col("node").alias(end), F.col("root").alias(f"_r{end}")), end, "left")
    return pairs.select("a", "b", F.coalesce("_ra", "a").alias("ra"), F.coalesce("_rb", "b").alias("rb"))


def _merged(labels: DataFrame | None, fresh: DataFrame, scratch: Scratch) -> DataFrame:
    """``labels`` after new links. Only the new links are searched, between the components they join."""
    found = components(_with_roots(fresh, labels).select(F.col("ra").alias("a"), F.col("rb").alias("b")), scratch)
    if labels is None:
        return found
    moved = labels.join(found.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left") \
        .select("node", F.coalesce("top", "root").alias("root"))
    added = found.join(labels.select("node"), "node", "left_anti").select("node", "root")
    out = scratch.save(moved.union(added), "labels")
    scratch.drop(labels, found)
    return out


def near_duplicates(docs: DataFrame, similarity: float = 0.8) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id (smallest doc_id of its class), class_size
    (rows of the class) and copies (rows with the same words). Other columns are not read."""
    return _classes(docs, similarity).select("doc_id", "class_id", "class_size", "copies")


def _classes(docs: DataFrame, similarity: float) -> DataFrame:
    """``near_duplicates`` with the node of every row and head, the node that stays of its class."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "near-dup")
    signed = scratch.save(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lower("text").alias("text")).mapInArrow(
            lean(_sign), "doc_id long, node long, sig binary, tiny binary, elements array<int>"), "signed")
    named = scratch.save(signed.select("doc_id", "node"), "named")
    # One row per distinct text: equal texts have equal signatures and elements.
    texts = named.groupBy("node").agg(F.min("doc_id").alias("first_id"))
    chosen = signed.join(texts, "node") \
        .filter(F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.size("elements") > 0))
    bands = scratch.save(
        chosen.select("node", "sig").mapInArrow(lean(_band), "bucket long, node long"), "bands")
    shared = bands.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high")) \
        .filter("low <> high").select("bucket")
    members = scratch.save(bands.join(shared, "bucket").distinct(), "members")
    scratch.drop(bands)
    wanted = members.select("node").distinct()
    kept = scratch.save(
        chosen.join(wanted, "node", "left_semi").select("node", "sig", "tiny", "elements")
        .dropDuplicates(["node"]), "kept")
    scratch.drop(signed)
    scratch.release()

    labels = None
    for neighbours in (0, NEIGHBOURS):
        divided = _divided(members, labels)
        if neighbours:
            divided = scratch.save(divided, "divided")
        pairs = _with_roots(_links(divided, neighbours), labels).filter("ra <> rb").select("a", "b")
        fresh = scratch.save(verified(pairs, kept, similarity), "links")
        if not fresh.isEmpty():
            labels = _merged(labels, fresh, scratch)
        scratch.drop(fresh)
        scratch.release()
    # What is too large for all its pairs. Many such buckets are one component by now.
    large = divided.filter(F.col("n") > NEIGHBOURS + 1).select("bucket", "node")
    open_ = scratch.save(
        _divided(large, labels).select("node", F.col("comp").alias("root")).distinct(), "open")
    scratch.drop(members, divided)
    if not open_.isEmpty():
        fresh = scratch.save(_exact(open_, kept, similarity, scratch), "links")
        if not fresh.isEmpty():
            labels = _merged(labels, fresh, scratch)
        scratch.drop(fresh)
    scratch.drop(open_)
    scratch.release()

    scratch.drop(kept)
    rows = named
    if labels is not None:
        rows = rows.join(labels, "node", "left")
    else:
        rows = rows.withColumn("root", F.col("node"))
    rows = rows.select("doc_id", "node", F.coalesce("root", "node").alias("root"))
    by_text = rows.groupBy("root", "node").agg(F.min("doc_id").alias("low"), F.count("*").alias("copies"))
    by_class = by_text.groupBy("root").agg(
        F.min(F.struct(F.col("low").isNull(), "low", "node")).alias("least"),
        F.sum("copies").alias("class_size"))
    of_text = by_text.select("root", "node", "copies").join(by_class, "root") \
        .select("node", F.col("least.low").alias("class_id"), F.col("least.node").alias("head"),
                "class_size", "copies")
    return rows.select("doc_id", "node").join(of_text, "node")


def verified(pairs: DataFrame, kept: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose exact weighted Jaccard similarity is at least ``similarity``.

    Signatures are compared first: a pair that agrees in far fewer coordinates (five standard
    deviations) needs no exact check.
    """
    tiny = kept.select("node", "tiny")
    likely = pairs \
        .join(tiny.withColumnsRenamed({"node": "a", "tiny": "sa"}), "a") \
        .join(tiny.withColumnsRenamed({"node": "b", "tiny": "sb"}), "b") \
        .select("a", "b", "sa", "sb").mapInArrow(lean(_agree), "a long, b long, agreement double") \
        .filter(F.col("agreement") >= similarity - SLACK).select("a", "b")
    sets = kept.select("node", "elements")
    both = F.size(F.array_intersect("ea", "eb"))
    return likely \
        .join(sets.withColumnsRenamed({"node": "a", "elements": "ea"}), "a") \
        .join(sets.withColumnsRenamed({"node": "b", "elements": "eb"}), "b") \
        .filter(both >= similarity * (F.size("ea") + F.size("eb") - both)) \
        .select("a", "b")


def _exact(open_: DataFrame, kept: DataFrame, similarity: float, scratch: Scratch) -> DataFrame:
    """Links (a, b) that connect all components of ``open_`` (node, root) with alike texts.

    Of elements that the same texts have in front one is enough. A group is cut into blocks of about
    BLOCK elements, and every two blocks meet in a task, so a row goes out once per block of its group.
    """
    context = open_.sparkSession.sparkContext
    sets = scratch.save(kept.join(open_, "node").select("node", "root", "elements"), "sets")
    found = sets.select("elements").mapInArrow(lean(_tally), "slot int, n long") \
        .groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(SLOTS, np.int64)
    counts[found.column("slot").to_numpy()] = found.column("n").to_numpy()
    first = scratch.save(
        sets.mapInArrow(lean(_prefixes(context.broadcast(counts), similarity)),
                        "token int, node long, root long, size int"), "first")
    groups = first.groupBy("token").agg(
        F.count("*").alias("n"), F.sum(F.greatest("size", F.lit(LEAST))).alias("total"),
        F.min("root").alias("low"), F.max("root").alias("high"),
        F.bit_xor(F.xxhash64("node")).alias("k"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("m"),
    ).filter("low <> high").groupBy("n", "k", "m").agg(F.min("token").alias("token"), F.min("total").alias("total"))
    blocks = F.ceil(F.col("total") / BLOCK).cast("int")
    placed = first.join(groups.select("token", blocks.alias("blocks")), "token") \
        .withColumn("block", F.pmod(F.xxhash64("node", F.lit(2)), "blocks").cast("int")) \
        .select("token", "node", "block", F.explode(F.expr("sequence(0, blocks - 1)")).alias("other")) \
        .select("token", "node", "block", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"))
    links = scratch.save(
        placed.join(sets, "node").groupBy("token", "x", "y")
        .applyInArrow(_compared(similarity), "a long, b long").distinct(), "exact")
    scratch.drop(sets, first)
    return links


def one_of_each(docs: DataFrame, similarity: float = 0.8) -> DataFrame:
    """The rows of ``docs`` with the smallest doc_id of each class; columns as they came. Of rows
    of one class that repeat that doc_id (or have none) one stays."""
    heads = _classes(docs, similarity) \
        .filter(F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("node") == F.col("head"))) \
        .select(F.col("doc_id").alias("_id"), F.col("node").alias("_head")).distinct()
    named = docs.withColumn("_node", _node_of(F.lower("text")))
    return named.join(
        heads, (F.col("_node") == F.col("_head")) & F.col("doc_id").cast("long").eqNullSafe(F.col("_id")), "left_semi") \
        .dropDuplicates(["doc_id", "_node"]).drop("_node")
