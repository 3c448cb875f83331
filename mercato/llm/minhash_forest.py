"""MinHash near-dedup with an LSH forest.

Every document's set of word shingles gets a signature of minima. Each tree of the forest reads the signature in an
order of its own; documents with a common prefix of that order are neighbours, and the longer the prefix the closer
they are. A region (the documents below one prefix) that holds few documents is compared completely at the shallowest
depth; a dense one is opened deeper, until it is small or the order ends. What is still dense at the first
useful depth is a group of close copies: nearly all of them join up over one likely partner each, and those that do not are
compared with all others in blocks, as products of 0/1 matrices, which give links only and never a list of pairs.
Pairs that are already joined up over others are never listed either. Opening a region deeper only joins up most of it
at less cost: its members at depth 4 are kept, and those that end up outside its largest component meet all of them.

All links are confirmed on full sets. Documents with equal sets stand behind one node before any of this, so copies
are never paired. Chance of not meeting at similarity s with T trees at depth d: (1 - s^d)^T; for s = 0.75, 24 trees,
that is 2e-6 at depth 3 and, in dense regions of any size, 1e-4 at depth 4.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm.kept import giving_back
from mercato.llm.links import components
from mercato.llm.store import saved
from mercato.llm.words import STEP, WordNumbers, mixed, shingle_set, split_words

SHINGLE = 5
SIMILAR = (75, 100)
TREES = 24
REGION, DENSE = 16, 4096
#: (values read, members up to which a region of this depth stays closed). From the second depth on a region is also kept whole.
DEPTHS = ((3, REGION), (4, DENSE), (6, DENSE), (9, DENSE), (12, None))
FIRST, LAST = DEPTHS[0][0], DEPTHS[-1][0]
VALUES = TREES * FIRST
BLOCK = 512
COLUMNS = 4096
MOST = np.uint32(0xFFFFFFFF)


def orders() -> list[list[int]]:
    """One order of signature positions for each tree: its own first three, then such as other trees begin with."""
    out = []
    for tree in range(TREES):
        own = list(range(FIRST * tree, FIRST * tree + FIRST))
        later = [(FIRST * (tree + 5 * step) + step % FIRST) % VALUES for step in range(1, LAST - FIRST + 1)]
        out.append(own + later)
    return out


def multipliers() -> np.ndarray:
    return mixed(np.arange(1, VALUES + 1, dtype=np.uint64) * STEP) | np.uint64(1)


def signature(shingles: np.ndarray, factors: np.ndarray) -> np.ndarray:
    out = np.full(len(factors), MOST, np.uint32)
    for at in range(0, len(shingles), 2048):
        high = (shingles[at:at + 2048, None] * factors) >> np.uint64(32)
        out = np.minimum(out, high.min(axis=0).astype(np.uint32))
    return out


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    numbers, factors = WordNumbers(), multipliers()
    for batch in batches:
        sizes, prints, signatures = [], [], []
        for text in batch.column(1):
            shingles = shingle_set(split_words(text.as_py()), numbers, SHINGLE)
            sizes.append(len(shingles))
            prints.append(np.frombuffer(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest(), np.int64))
            signatures.append(signature(shingles, factors).view(np.int32) if len(shingles) else np.empty(0, np.int32))
        prints = np.array(prints, np.int64).reshape(-1, 2)
        offsets = np.concatenate([[0], np.cumsum([len(s) for s in signatures])]).astype(np.int32)
        flat = np.concatenate(signatures) if signatures else np.empty(0, np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(prints[:, 0]), pa.array(prints[:, 1]),
             pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
            ["doc_id", "n_shingles", "set_a", "set_b", "signature"])


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        giving_back(_sketch), "doc_id long, n_shingles long, set_a long, set_b long, signature array<int>")


def _prefix(depth: int) -> Column:
    """Key of a row's region: its tree and the first values of the signature in that tree's order."""
    each = [F.array(*[F.lit(i + 1) for i in order[:depth]]) for order in orders()]
    positions = F.element_at(F.array(*each), F.col("tree") + 1)
    return F.xxhash64("tree", F.transform(positions, lambda i: F.element_at("signature", i)))


def regions(nodes: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """nodes (node, signature) to the members (region, n, least, node) of each tree's regions of two or more.

    A row's region is the shallowest that has as few members as DEPTHS allows, else the deepest. Members are counted by
    a grouping with map-side counts, so no region is ever gathered in a task. Second, in the same form, the regions of the
    second depth that were opened deeper, with all their members; None if there are none.
    """
    rows = nodes.select("node", "signature", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"))
    out = whole = None
    for step, (depth, most) in enumerate(DEPTHS):
        keyed = rows.select("node", "tree", _prefix(depth).alias("region"))
        sizes = keyed.groupBy("region").agg(F.count("*").alias("n"), F.min("node").alias("least"),
                                            F.max("node").alias("last")).filter("least < last").drop("last")
        members = saved(keyed.join(sizes, "region"), "members")
        dense = None if most is None else members.filter(F.col("n") > most)
        last = dense is None or dense.isEmpty()
        final = (members if last else members.filter(F.col("n") <= most)).select("region", "n", "least", "node")
        out = final if out is None else out.unionByName(final)
        if last:
            return out, whole
        if step == 1:
            whole = dense.select("region", "n", "least", "node")
        rows = dense.select("node", "tree").join(nodes, "node")


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (a, block, role, b): the text of a (role 0), then those of its partners in this block."""
    numbers, at, base = WordNumbers(), None, []
    for batch in batches:
        a_col, block_col, role_col, b_col = (batch.column(i).to_pylist() for i in range(4))
        out = []
        for i, role in enumerate(role_col):
            shingles = shingle_set(split_words(batch.column(4)[i].as_py()), numbers, SHINGLE)
            if role == 0:
                if at != (a_col[i], block_col[i]):
                    at, base = (a_col[i], block_col[i]), []
                base.append(shingles)
                continue
            for own in base if at == (a_col[i], block_col[i]) else []:
                both = len(np.intersect1d(own, shingles, assume_unique=True))
                out.append((a_col[i], b_col[i], both, len(own) + len(shingles) - both))
        columns = list(zip(*out)) if out else [[], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b", "shared", "either"])


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """pairs (a, b) with the sizes of intersection and union of their full sets.

    A node with many partners meets them in blocks of about BLOCK, each with one copy of its text; a task holds one
    set and a batch at a time.
    """
    degree = pairs.groupBy("a").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    partners = pairs.join(degree, "a").select(
        "a", F.pmod(F.xxhash64("b"), F.col("blocks")).cast("int").alias("block"), F.lit(1).alias("role"), F.col("b").alias("node"))
    heads = degree.select("a", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
                          F.lit(0).alias("role"), F.col("a").alias("node"))
    rows = partners.unionByName(heads).join(texts, "node").select("a", "block", "role", "node", "text")
    dealt = rows.repartition("a", "block").sortWithinPartitions("a", "block", "role", "node")
    return (dealt.mapInArrow(giving_back(_compare), "a long, b long, shared long, either long")
            .groupBy("a", "b").agg(F.max_by(F.struct("shared", "either"), F.col("shared") / F.col("either")).alias("s"))
            .select("a", "b", "s.shared", "s.either"))


def _linked() -> Column:
    return F.col("shared") * SIMILAR[1] >= F.col("either") * SIMILAR[0]


def _nearest(members: DataFrame) -> DataFrame:
    """Of each node's regions' least nodes the one it shares most regions with."""
    shared = members.filter("node != least").groupBy("node", "least").agg(F.count("*").alias("hits"))
    return shared.groupBy("node").agg(F.max_by("least", F.struct("hits", -F.col("least"))).alias("a")).select(
        "a", F.col("node").alias("b"))


def _parted(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of the regions that still hold more than one component, with their component as `part`."""
    rows = members.join(labels, "node", "left").select("region", "n", "least", "node", F.coalesce("component", "node").alias("part"))
    mixed = rows.groupBy("region").agg(F.min("part").alias("p"), F.max("part").alias("q")).filter("p < q").select("region")
    return rows.join(mixed, "region")


def _pairs_of(own: Column) -> Column:
    """Of a short sorted list of (node, part) each pair whose parts differ."""
    pairs = F.flatten(F.transform(own, lambda x, i: F.transform(
        F.slice(own, i + F.lit(2), F.lit(REGION)),
        lambda y: F.struct(x["node"].alias("a"), y["node"].alias("b"), (x["part"] != y["part"]).alias("apart")))))
    return F.filter(pairs, lambda p: p["apart"])


def _open_pairs(parted: DataFrame) -> DataFrame:
    """Of small regions all pairs between components."""
    return (parted.filter(F.col("n") <= REGION).groupBy("region")
            .agg(F.sort_array(F.collect_set(F.struct("node", "part"))).alias("own"))
            .select(F.inline(_pairs_of(F.col("own")))).select("a", "b").distinct())


def _matrix(sets: list[np.ndarray], known: np.ndarray) -> np.ndarray:
    """0/1 rows: which of the known shingles each set holds."""
    out = np.zeros((len(sets), len(known)), np.float32)
    for row, own in zip(out, sets):
        at = np.minimum(np.searchsorted(known, own), len(known) - 1)
        row[at[known[at] == own]] = 1
    return out


def linked_pairs(left: list[np.ndarray], right: list[np.ndarray]) -> list[tuple[int, int]]:
    """Positions of the pairs of sets that are linked: exact sizes of all intersections, some thousand shingles at a time."""
    if not left or not right:
        return []
    known = np.intersect1d(np.concatenate(left), np.concatenate(right))
    shared = np.zeros((len(left), len(right)), np.float32)
    for at in range(0, len(known), COLUMNS):
        part = known[at:at + COLUMNS]
        shared += _matrix(left, part) @ _matrix(right, part).T
    either = np.array([[len(x)] for x in left]) + np.array([len(x) for x in right]) - shared
    return list(zip(*(side.tolist() for side in np.nonzero(shared * SIMILAR[1] >= either * SIMILAR[0]))))


def _block_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (region, i, j, side): a block of members outside the main component, then one of any members.

    Per outside member and component one link is given. Two blocks are held at a time.
    """
    numbers, now, sides, found = WordNumbers(), None, ([], []), set()

    def close() -> None:
        best: dict[tuple[int, int], int] = {}
        sets = [[x[2] for x in side] for side in sides]
        for x, y in linked_pairs(*sets):
            (a, a_part, _), (b, b_part, _) = sides[0][x], sides[1][y]
            if a_part != b_part:
                best.setdefault((a, b_part), b)
        found.update((min(a, b), max(a, b)) for (a, _), b in best.items())

    def give() -> pa.RecordBatch:
        columns = list(zip(*sorted(found))) or [[], []]
        found.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b"])

    for batch in batches:
        keys = list(zip(*(batch.column(c).to_pylist() for c in range(6))))
        for (region, i, j, side, node, part), text in zip(keys, batch.column(6)):
            if now != (region, i, j):
                close()
                now, sides = (region, i, j), ([], [])
            sides[side].append((node, part, shingle_set(split_words(text.as_py()), numbers, SHINGLE)))
        yield give()
    close()
    yield give()


def _dense_links(parted: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b) between components inside dense regions.

    The members outside the region's largest component meet all its members, block by block. A block pair is one unit of
    work of bounded size, however large the region; few members outside make few blocks.
    """
    rows = parted.filter(F.col("n") > REGION)
    home = rows.groupBy("region", "part").agg(F.count("*").alias("own")).groupBy("region").agg(
        F.max_by("part", F.struct("own", -F.col("part"))).alias("home"), (F.sum("own") - F.max("own")).alias("others"))
    blocks, others = (F.ceil(F.col(c) / BLOCK).cast("int") for c in ("n", "others"))
    place = lambda among: F.pmod(F.xxhash64("node"), among).cast("int")
    rows = saved(rows.join(home, "region").select(
        "region", "node", "part", "home", blocks.alias("blocks"), place(blocks).alias("own"),
        others.alias("outer"), place(others).alias("out")), "dense")
    each = lambda among: F.explode(F.sequence(F.lit(0), F.col(among) - 1))
    first = rows.filter("part != home").select(
        "region", F.col("out").alias("i"), each("blocks").alias("j"), F.lit(0).alias("side"), "node", "part")
    any_member = rows.select("region", each("outer").alias("i"), F.col("own").alias("j"), F.lit(1).alias("side"), "node", "part")
    met = first.unionByName(any_member.select(first.columns)).join(texts, "node").select(
        "region", "i", "j", "side", "node", "part", "text")
    dealt = met.repartition("region", "i", "j").sortWithinPartitions("region", "i", "j", "side", "node")
    return dealt.mapInArrow(giving_back(_block_links), "a long, b long").distinct()


def linked_nodes(nodes: DataFrame, texts_of) -> DataFrame:
    """(node, component) of the nodes that are linked to a lesser one. texts_of: ids (node) to (node, text).

    First every node is compared with one likely partner, which joins up most groups. Then only what is still apart is
    compared: pairs of small regions, blocks of dense ones, last the dense ones that were opened deeper, as they were before.
    """
    members, whole = regions(nodes)
    ids = members.select("node") if whole is None else members.select("node").unionByName(whole.select("node"))
    texts = saved(texts_of(ids.distinct()), "texts")
    seen = saved(confirmed(_nearest(members), texts), "confirmed")
    links = seen.filter(_linked()).select("a", "b")
    labels = components(links)
    parted = saved(_parted(members, labels), "parted")
    if not parted.isEmpty():
        links = saved(links.unionByName(_links_between(parted, seen, texts)), "linked")
        labels = components(links)
    if whole is None:
        return labels
    apart = saved(_parted(whole, labels), "apart")
    if apart.isEmpty():
        return labels
    return components(links.unionByName(_dense_links(apart, texts)))


def _links_between(parted: DataFrame, seen: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b) between components inside regions; seen: pairs that were compared before."""
    pairs = saved(_open_pairs(parted).join(seen.select("a", "b"), ["a", "b"], "left_anti"), "pairs")
    more = confirmed(pairs, texts).filter(_linked()).select("a", "b")
    if not parted.filter(F.col("n") > REGION).isEmpty():
        more = more.unionByName(_dense_links(parted, texts))
    return more


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id, kept.

    Sets of distinct five-word shingles, linked at a Jaccard similarity of 0.75 or more; component_id is the least id
    reached over links, kept tells that it is the document's own. Texts without a word (null, empty, blank) have no
    shingles and are linked with nothing. Texts of under five words have one shingle. Rows that share an id but not
    the text are judged each by its own text. A null id is linked with nothing, has a null component and is kept.
    Other columns are ignored, whatever their names.
    """
    sketch = saved(sketches(docs, id_col, text_col), "sketches")
    real = sketch.filter("n_shingles > 0 and doc_id is not null")
    heads = saved(real.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("node")), "heads")
    nodes = (real.join(heads.select("set_a", "set_b", F.col("node").alias("doc_id")), ["set_a", "set_b", "doc_id"], "left_semi")
             .select(F.col("doc_id").alias("node"), "signature"))
    texts = docs.select(F.col(id_col).cast("long").alias("node"), F.col(text_col).cast("string").alias("text"))
    labels = linked_nodes(saved(nodes, "nodes"), lambda ids: texts.join(ids, "node", "left_semi"))
    own = heads.join(labels, "node", "left").select("set_a", "set_b", F.coalesce("component", "node").alias("component"))
    by_set = sketch.drop("signature").join(own, ["set_a", "set_b"], "left")
    part = F.when(F.col("n_shingles") > 0, F.when(F.col("doc_id").isNotNull(), F.col("component"))).otherwise(F.col("doc_id"))
    return by_set.select("doc_id", "n_shingles", part.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
