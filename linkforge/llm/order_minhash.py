"""Near-dedup with Order MinHash.

A text is its sequence of 5-word shingles, each labelled with its occurrence number. A sketch is
the ``take`` labelled shingles with the smallest hashes in the order in which the text has them;
texts that agree in one of ``sketches`` independent sketches are candidates. Similarity is
aligned / (a + b - aligned), where aligned is the longest common subsequence of the two labelled
sequences, found by a banded alignment: 0.8 or more is near. It is the Jaccard similarity of the
shingles where their order agrees, and less where it does not.

Texts with equal word sequences are one class and compared once. Candidate links form blocks
(connected components of cheap 16-byte links); a block's word hashes meet once, and inside it all
candidate pairs that are not yet connected are verified. Only verified links make the result.

A block of many texts first shrinks in linear rounds: each text is compared with one text it shares
a sketch with, and sketches whose texts are all connected are done with. What is left meets sketch
by sketch, so a text moves once per sketch however large its block is, and a pair is compared under
the smallest sketch that it shares. Sketches of texts of few shingles often differ; two texts of at
most nine shingles between them are 0.8 similar only if one is the other less one shingle, and an
equi-join finds all of those. Only where the texts of one sketch are many and not connected
are they dealt out in pairs of slices; those of its largest connected part meet the others only.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, connected_components, id_text, materialise, mix, occurrence, releasing, rolling, text_bytes, words

GRAM, LEAST, SKETCHES, TAKE = 5, 0.8, 14, 4
#: Texts of up to this many shingles are also met with what they are less one shingle: any pair
#: whose union has no more and that is 0.8 similar differs in one.
SHORT = 9
#: Texts of a block or, in larger blocks, of a sketch that meet in one task.
SLICE = 1500
#: Linear rounds at most; they save work only, as what they leave open is compared after them.
ROUNDS = 4


def labelled(h: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """Occurrence-labelled shingles of one word sequence, in order; fewer words than ``gram`` make
    one shingle of all of them, none make none."""
    if not len(h):
        return np.zeros(0, np.uint64)
    s = rolling(h, min(gram, len(h)))
    return mix(s + occurrence(s).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))


def sketch_keys(x: np.ndarray, sketches: int = SKETCHES, take: int = TAKE) -> np.ndarray:
    """One 64-bit key per sketch of a labelled sequence."""
    out = np.empty(sketches, np.uint64)
    k = min(take, len(x))
    for i in range(sketches):
        h = mix(x ^ np.uint64((i + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        at = np.argpartition(h, k - 1)[:k] if k < len(h) else np.arange(k)
        at.sort()  # text order, not order of the hashes
        out[i] = rolling(h[at], k)[0] + np.uint64(i)
    return mix(out)


def aligned(a: np.ndarray, b: np.ndarray, need: int) -> int:
    """Longest common subsequence of two sequences without repeats if it is at least ``need``,
    else something less. Alignments that reach ``need`` stay within a band of the diagonal, as
    each place off it costs an unmatched shingle."""
    short = min(len(a), len(b))
    if short < need:
        return 0
    p = 0
    same = a[:short] == b[:short]
    p = short if same.all() else int(np.argmin(same))
    q = 0
    if p < short:
        same = a[len(a) - short + p :][::-1] == b[len(b) - short + p :][::-1]
        q = len(same) if same.all() else int(np.argmin(same))
    a, b = a[p : len(a) - q], b[p : len(b) - q]
    if not len(a) or not len(b):
        return p + q
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    band = len(a) + len(b) - 2 * (need - p - q)
    near = np.abs(i - j) <= band
    i, j = i[near], j[near]
    if p + q + len(i) < need:
        return 0
    j = j[np.argsort(i)]
    if (j[1:] > j[:-1]).all():
        return p + q + len(j)
    tails: list[int] = []
    for x in j.tolist():
        k = bisect_left(tails, x)
        tails[k : k + 1] = [x]
    return p + q + len(tails)


def similar(a: np.ndarray, b: np.ndarray, least: float = LEAST) -> bool:
    """Whether aligned / (a + b - aligned) >= least, exactly."""
    n = len(a) + len(b)
    need = int(np.ceil(least * n / (1 + least) - 1e-9))
    if not n or not need:
        return False
    got = aligned(a, b, need)
    return got >= least * (n - got) - 1e-9


def _sketches(sketches: int, take: int):
    def run(batches):
        for b in batches:
            data, off = text_bytes(b.column("text"))
            whole, keys, few = [], [], []
            for i, j in chunks(off):
                _, _, h, at = words(data[off[i] : off[j]], off[i : j + 1] - off[i], lower=True)
                for k in range(j - i):
                    w = h[at[k] : at[k + 1]]
                    if not len(w):
                        whole.append(None)
                        keys.append(None)
                        few.append(None)
                        continue
                    whole.append((int(rolling(w, len(w))[0]) ^ len(w)) - (1 << 63))
                    x = labelled(w)
                    keys.append(sketch_keys(x, sketches, take).view(np.int64).tolist())
                    few.append(x.view(np.int64).tolist() if len(x) <= SHORT else None)
            longs = pa.list_(pa.int64())
            yield pa.record_batch(
                [b.column("doc_id"), pa.array(whole, pa.int64()), pa.array(keys, longs), b.column("text_key"), pa.array(few, longs)],
                names=["doc_id", "node", "keys", "text_key", "few"],
            )

    return run


def _sequences(batches):
    seen: set[int] = set()  # a partition sends equal texts once
    for b in batches:
        data, off = text_bytes(b.column("text"))
        whole, seq = [], []
        for i, j in chunks(off):
            _, _, h, at = words(data[off[i] : off[j]], off[i : j + 1] - off[i], lower=True)
            for k in range(j - i):
                w = h[at[k] : at[k + 1]]
                if len(w) and (node := (int(rolling(w, len(w))[0]) ^ len(w)) - (1 << 63)) not in seen:
                    seen.add(node)
                    whole.append(node)
                    seq.append(w.astype("<u4").tobytes())
        yield pa.record_batch([pa.array(whole, pa.int64()), pa.array(seq, pa.binary())], names=["node", "words"])


def link_block(
    nodes: list[int], seqs: list[np.ndarray], keys: list[np.ndarray], side: list[int], least: float = LEAST, comp: list[int] | None = None, only: int | None = None
) -> list[tuple[int, int]]:
    """Verified links that connect exactly what all verified candidate pairs would: pairs that
    are connected already (those of one ``comp`` are from the start) are passed over. Only pairs
    of different sides are compared where there are two (a slice with itself has one). With
    ``only``, all texts have that key, and it takes the pairs of which it is the smallest common key."""
    first: dict[int, int] = {}
    up = [first.setdefault(c, i) for i, c in enumerate(nodes if comp is None else comp)]

    def root(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    cross = len(set(side)) > 1
    buckets: dict[int, list[int]] = defaultdict(list)
    below: list[set[int]] = []  # keys of each text that come before the only one
    if only is None:
        for i, ks in enumerate(keys):
            for k in ks.tolist():
                buckets[k].append(i)
    else:
        buckets[only] = list(range(len(nodes)))
        below = [{k for k in ks.tolist() if k < only} for ks in keys]
    sizes = [len(s) for s in seqs]
    tried: set[tuple[int, int]] = set()
    links = []
    for members in sorted({tuple(m) for m in buckets.values() if len(m) > 1}, key=lambda m: (len(m), m)):
        groups: dict[int, list[int]] = defaultdict(list)
        for i in members:
            groups[root(i)].append(i)
        if len(groups) == 1:
            continue
        done: list[list[int]] = []  # groups of this bucket that are known to be apart
        for mine in groups.values():
            for other in list(done):
                hit = None
                for i in mine:
                    for j in other:
                        if cross and side[i] == side[j]:
                            continue
                        pair = (i, j) if i < j else (j, i)
                        if only is None:
                            if pair in tried:
                                continue
                            tried.add(pair)
                        elif not below[i].isdisjoint(below[j]):
                            continue
                        x, y = sizes[i], sizes[j]
                        if min(x, y) >= least * max(x, y) - 1e-9 and similar(seqs[i], seqs[j], least):
                            hit = pair
                            break
                    if hit:
                        break
                if hit:
                    links.append((nodes[hit[0]], nodes[hit[1]]))
                    up[root(hit[0])] = root(hit[1])
                    mine = mine + other
                    done.remove(other)
            done.append(mine)
    return links


def _verify(least: float, gram: int):
    def run(group, t):
        nodes = t.column("node").to_pylist()
        seqs = [labelled(np.frombuffer(x, "<u4").astype(np.uint64), gram) for x in t.column("words").to_pylist()]
        keys = [np.array(k, np.int64) for k in t.column("keys").to_pylist()]
        only = group[1].as_py() if group[0].as_py() else None
        links = link_block(nodes, seqs, keys, t.column("slice").to_pylist(), least, t.column("comp").to_pylist(), only)
        return pa.table({"u": pa.array([x for x, _ in links], pa.int64()), "v": pa.array([x for _, x in links], pa.int64())})

    return run


def _compare(least: float, gram: int):
    """Pairs with the words of both: those that are near."""

    def run(batches):
        last, right = None, None
        for b in batches:
            near = []
            for v, x, y in zip(b.column("v").to_pylist(), b.column("left"), b.column("right"), strict=True):
                if v != last:  # pairs come sorted by v
                    last, right = v, labelled(np.frombuffer(y.as_buffer(), "<u4").astype(np.uint64), gram)
                near.append(similar(labelled(np.frombuffer(x.as_buffer(), "<u4").astype(np.uint64), gram), right, least))
            yield b.select(["u", "v"]).filter(pa.array(near, pa.bool_()))

    return run


def _joined(nodes: DataFrame, comp: DataFrame | None) -> DataFrame:
    """(node, key, comp) of (node, keys): comp is the connected part of a node, itself where nothing
    is linked yet. Nodes are joined before their keys are unfolded."""
    if comp is None:
        nodes = nodes.withColumn("comp", F.col("node"))
    else:
        nodes = nodes.join(comp, "node", "left").withColumn("comp", F.coalesce("component", "node"))
    return nodes.select("node", F.explode(F.array_distinct("keys")).alias("key"), "comp")


def _shrink(nodes: DataFrame, words_of: DataFrame, least: float, rounds: int) -> tuple[DataFrame | None, DataFrame]:
    """Verified links of linear rounds, and (node, key, comp) of the keys whose nodes they don't
    all connect. In each round a key that is open picks one of its connected parts, by a hash that
    changes with the round, and each node outside compares itself with a node of one such part. A
    node that very many are compared with is copied in proportion, so that no task gets them all."""
    links, comp = None, None
    for r in range(rounds):
        now = _joined(nodes, comp)
        pick = F.struct(F.xxhash64("comp", F.lit(r)).alias("turn"), "comp", "node")
        centre = now.groupBy("key").agg(F.min(pick).alias("c"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi")
        picked = now.join(centre, "key").where(F.col("comp") != F.col("c.comp")).groupBy("node").agg(F.min("c").alias("c"))
        picked = materialise(picked.select(F.col("node").alias("u"), F.col("c.node").alias("v")), "omh-picked")
        if picked.isEmpty():
            break
        copies = picked.groupBy("v").agg(F.ceil(F.count(F.lit(1)) / F.lit(SLICE)).cast("int").alias("copies"))
        right = copies.join(words_of.toDF("v", "right"), "v").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))).drop("copies")
        left = picked.join(copies, "v").withColumn("copy", F.pmod(F.xxhash64("u"), F.col("copies")).cast("int")).drop("copies")
        pairs = left.join(words_of.toDF("u", "left"), "u").join(right, ["v", "copy"]).sortWithinPartitions("v")
        new = materialise(pairs.select("u", "v", "left", "right").mapInArrow(releasing(_compare(least, GRAM)), "u long, v long"), "omh-stars")
        if new.isEmpty():
            break
        links = new if links is None else links.unionByName(new)
        comp = materialise(connected_components(links), "omh-parts").select("node", "component")
    now = _joined(nodes, comp)
    still = now.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("key")
    return links, materialise(now.join(still, "key"), "omh-open")


def _dealt(rest: DataFrame) -> DataFrame:
    """What ``_shrink`` leaves, by key: one slice where its nodes are few, else slices of the largest
    connected part and slices of the others, in such pairs that all nodes meet except two of that
    part. ``keys`` are the open keys of a node, which include all that it shares with nodes that it
    is not connected with."""
    parts = rest.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n"))
    sizes = parts.groupBy("key").agg(F.sum("n").alias("n"), F.max(F.struct("n", "comp")).alias("top"))
    few = F.col("n") <= SLICE
    others = F.when(few, 1).otherwise(F.ceil((F.col("n") - F.col("top.n")) / F.lit(SLICE))).cast("int")
    most = F.when(few, 0).otherwise(F.ceil(F.col("top.n") / F.lit(SLICE))).cast("int")
    sized = sizes.select("key", F.col("top.comp").alias("top"), others.alias("others"), most.alias("most"))
    within = lambda n: F.pmod(F.xxhash64("node"), n.cast("long")).cast("int")
    in_top = (F.col("most") > 0) & (F.col("comp") == F.col("top"))
    keys = rest.groupBy("node").agg(F.collect_list("key").alias("keys"))
    return rest.join(sized, "key").join(keys, "node").select(
        "node", F.lit(True).alias("by_key"), F.col("key").alias("block"), "keys", "comp",
        F.when(in_top, F.col("others") + within(F.greatest("most", F.lit(1)))).otherwise(within(F.col("others"))).alias("slice"),
        F.when(in_top, F.col("others")).otherwise(F.col("others") + F.col("most")).alias("meets"),
    )


def _one_less(rows: DataFrame, least: float) -> DataFrame:
    """(u, v) of texts of few shingles of which v is u less one shingle, where that is near. Sequences
    are compared themselves, so each pair is verified, and u has at most ``SHORT`` partners: equal
    sequences are one class."""
    few = rows.where("few is not null").select("node", "few").dropDuplicates(["node"])
    n = F.size("few")
    less = few.where((n > 1) & ((n - 1) >= F.lit(least) * n - 1e-9)).withColumn("i", F.explode(F.sequence(F.lit(1), n)))
    less = less.select(F.col("node").alias("u"), F.concat(F.slice("few", F.lit(1), F.col("i") - 1), F.slice("few", F.col("i") + 1, n)).alias("few"))
    return less.join(few.withColumnRenamed("node", "v"), "few").select("u", "v").distinct()


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST, sketches: int = SKETCHES, take: int = TAKE) -> DataFrame:
    """One row per input row: doc_id, component_id, kept, text_key (a hash of the text, to find
    the row by where ids repeat).

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased. component_id is the smallest doc_id of
    the texts that verified links connect; kept is true for that document (each row of it, should
    ids repeat). Texts of fewer than five words are one shingle of all their words, so only equal
    ones are near. Null texts and texts without words link with nothing: their component is their
    own id. Null ids have a null component unless linked with others. Other columns are not read.
    An empty table gives no rows.
    """
    base = id_text(docs, id_col, text_col)
    base = base.withColumn("text_key", F.xxhash64("text"))
    rows = materialise(base.mapInArrow(releasing(_sketches(sketches, take)), "doc_id long, node long, keys array<long>, text_key long, few array<long>"), "omh-rows")
    # classes of equal word sequences; what follows sees each once
    classes = rows.where("node is not null").groupBy("node").agg(F.first("keys").alias("keys"), F.min("doc_id").alias("least_id"))
    keyed = classes.select("node", F.explode(F.array_distinct("keys")).alias("key"))
    centre = keyed.groupBy("key").agg(F.min("node").alias("c"), F.count(F.lit(1)).alias("n")).where("n > 1")
    stars = keyed.join(centre.select("key", "c"), "key").where("node <> c").select(F.col("node").alias("u"), F.col("c").alias("v"))
    blocks = materialise(connected_components(stars).withColumnRenamed("component", "block"), "omh-blocks")
    sizes = blocks.groupBy("block").agg(F.count(F.lit(1)).alias("n"))
    sized = blocks.join(sizes, "block")
    seqs = base.mapInArrow(releasing(_sequences), "node long, words binary")
    large = materialise(sized.where(F.col("n") > SLICE).select("node"), "omh-large")
    known = sized.where(F.col("n") <= SLICE).join(classes.select("node", "keys"), "node").select(
        "node", F.lit(False).alias("by_key"), "block", "keys", F.col("node").alias("comp"), F.lit(0).alias("slice"), F.lit(1).alias("meets"))
    found_so_far = None
    if large.isEmpty():
        having = seqs.join(known, "node").dropDuplicates(["node"])
    else:
        seqs = materialise(seqs.join(blocks.select("node"), "node", "left_semi").dropDuplicates(["node"]), "omh-words")
        hot = seqs.join(large, "node", "left_semi")
        found_so_far, rest = _shrink(materialise(classes.select("node", "keys").join(large, "node", "left_semi"), "omh-hot"), hot, least, ROUNDS)
        having = seqs.join(known.unionByName(_dealt(rest)), "node")
    # slices that have something to compare meet in one task
    pair = lambda o: F.struct(F.least("slice", o).alias("a"), F.greatest("slice", o).alias("b"))
    met = having.withColumn("pair", F.explode(F.transform(F.sequence(F.lit(0), F.col("meets") - 1), pair))).select(
        "by_key", "block", "pair.a", "pair.b", "node", "words", "keys", "slice", "comp")
    links = materialise(met.groupBy("by_key", "block", "a", "b").applyInArrow(_verify(least, GRAM), "u long, v long"), "omh-links")
    links = links if found_so_far is None else links.unionByName(found_so_far)
    found = connected_components(links.unionByName(_one_less(rows, least)))
    labels = found.join(classes.select(F.col("node"), "least_id"), "node")
    smallest = labels.groupBy("component").agg(F.min("least_id").alias("component_id"))
    moved = labels.join(smallest, "component").select("node", F.col("component_id").alias("linked"))
    same = classes.select("node", "least_id")
    final = same.join(moved, "node", "left").select(F.col("node").alias("k"), F.coalesce("linked", "least_id").alias("component_id"))
    out = rows.select("doc_id", "node", "text_key").join(final, F.col("node") == F.col("k"), "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept"), "text_key")
