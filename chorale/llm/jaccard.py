"""Documents whose sets of word shingles are alike (Jaccard join), by parity sketches.

*Sets*: words in lower case (A-Z only), windows of ``shingle`` words as 64-bit hashes; a shorter text is one shingle.
Equal sets are one *class* from the start: copies never meet as pairs.

*Sketches*: with ``percent`` p, linked sets of which the smaller has at most U members differ in at most
D = U * (100 - p) / p members.  Sizes are cut into bands; in a band the hash range is cut into D + 1 + m blocks, and each
block's members are XORed into one word.  A differing member changes one block, so the number of blocks that differ
is a lower bound of the symmetric difference, and linked sets agree in at least m + 1 whole blocks (pigeonhole).  Blocks
without members say little and are shared by many; a set with at most m of them leaves them out, as one of the blocks that
it shares has members then.  A set also enters every lower band that holds sets large enough to be linked with it, so linked sets always
share a band.  Finer sketches (one parity bit per hash value modulo a power of two, at least twice as many bits as members) give a
Hamming distance that is a lower bound as well, and sort out candidates before sets are compared.

*Join*: blocks are shuffled once as (word, class).  Links are then verified on the members of the sets:
  1. every class with the class it agrees with in most blocks, of the least classes of its blocks;
  2. blocks that hold several components after that: a spanning forest of the pairs that the sketch does not rule out, closest first;
  3. blocks that still do: their classes with such a pair are compared, members with members, inside the task that holds the
     block, which puts out a link only where it joins two components.
No step makes more pairs than there are classes in the blocks, linked or not, and no link between components is lost.
Blocks of more than ``TILE`` classes are compared tile by tile in separate rows.

Defined results: null, empty and blank texts have no shingles and are components of their own; a null id is a document whose id
is greater than any other; repeated rows are copies; an empty table gives no rows; very long texts are read
whole; columns other than id and text are not read.  Shingles count as equal if their 64-bit hashes are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chorale.llm.common import keep_once, row_key, small_batches
from chorale.llm.components import connected_components
from chorale.session import materialise

TILE = 2048
_MIX1, _MIX2, _STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit words."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.Array, k: int) -> list[np.ndarray]:
    """Sorted different 64-bit hashes of the shingles of each text."""
    import xxhash

    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    words = lists.flatten().dictionary_encode()
    names = words.dictionary.to_pylist()
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in names), dtype=np.uint64, count=len(names))
    blank = names.index("") if "" in names else -1
    codes = words.indices.to_numpy()
    h = hashes[codes] if len(names) else np.zeros(0, dtype=np.uint64)
    out = []
    with np.errstate(over="ignore"):
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            own = h[a:b]
            if blank >= 0:
                own = own[codes[a:b] != blank]
            n = len(own)
            if not n:
                out.append(own)
                continue
            width = min(n, k)
            s = np.full(n - width + 1, width, dtype=np.uint64)
            for i in range(width):
                s = mix(s * _STEP + own[i:n - width + 1 + i])
            out.append(np.unique(s))
    return out


def band_edges(n: int) -> list[int]:
    """Lower ends of the bands up to that of size n: 1, 2, 3, 4, 6, 9, ... each about half as large again."""
    edges = [1]
    while edges[-1] <= n:
        edges.append(max(edges[-1] + 1, edges[-1] * 3 // 2))
    return edges


def blocks(members: np.ndarray, percent: int) -> np.ndarray:
    """One word per block and band of a set: scrambled (band, block, count, XOR of the members in the block)."""
    n = len(members)
    edges = band_edges(n)
    own = len(edges) - 2
    # A lower band holds smaller sets up to edges[band + 1] - 1; those can be linked with sets up to that / p.
    bands = [own] + [band for band in range(own) if n * percent <= (edges[band + 1] - 1) * 100]
    out = []
    with np.errstate(over="ignore"):
        for band in bands:
            most = (edges[band + 1] - 1) * (100 - percent) // percent  # members that linked sets can differ in
            spare = most // 10 + 3
            count = most + 1 + spare
            at = ((members >> np.uint64(32)) * np.uint64(count) >> np.uint64(32)).astype(np.int64)
            size = np.bincount(at, minlength=count)
            words = np.zeros(count, dtype=np.uint64)
            full = np.flatnonzero(size)
            words[full] = np.bitwise_xor.reduceat(members, (np.cumsum(size) - size)[full])
            tag = mix(np.arange(count, dtype=np.uint64) + np.uint64(band << 40))
            told = mix(words ^ mix(tag + size.astype(np.uint64)))
            out.append(told[full] if count - len(full) <= spare else told)
    return np.concatenate(out)


def bit_sketch(members: np.ndarray) -> np.ndarray:
    """Parity of the members that fall on each bit; the number of bits is a power of two from 128 on, at least twice the size."""
    bits = 128
    while bits < 2 * len(members):
        bits *= 2
    at = (members & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8))


def fold(sketch: np.ndarray, size: int) -> np.ndarray:
    """The sketch with fewer bits: positions modulo a smaller power of two."""
    while len(sketch) > size:
        half = len(sketch) // 2
        sketch = sketch[:half] ^ sketch[half:]
    return sketch


def sets_table(docs: DataFrame, id_col: str, text_col: str, shingle: int, percent: int) -> DataFrame:
    """node (a number for each row), doc_id, row_key, n, set_key (128 bits), blocks, sketch; one row per row of ``docs``."""
    import hashlib

    small_batches(docs.sparkSession)
    rows = docs.select(F.monotonically_increasing_id().alias("node"), F.col(id_col).alias("doc_id"),
                       row_key(id_col, text_col).alias("row_key"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = shingle_sets(b.column(3), shingle)
            yield pa.RecordBatch.from_arrays([
                b.column(0), b.column(1), b.column(2), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                pa.array([blocks(s, percent).view(np.int64) if len(s) else [] for s in sets], pa.list_(pa.int64())),
                pa.array([bit_sketch(s).tobytes() if len(s) else b"" for s in sets], pa.binary())],
                ["node", "doc_id", "row_key", "n", "set_key", "blocks", "sketch"])

    return materialise(rows.mapInArrow(
        run, f"node bigint, doc_id {dict(rows.dtypes)['doc_id']}, row_key bigint, n bigint, set_key binary, "
             "blocks array<bigint>, sketch binary"), "jaccard-sets")


def linked(a: int, b: int, both: int, percent: int) -> bool:
    return 100 * both >= percent * (a + b - both)


def members_table(texts: DataFrame, shingle: int) -> DataFrame:
    """class, text -> class, members (sorted hashes), as a written table."""
    small_batches(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = shingle_sets(b.column(1), shingle)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x.tobytes() for x in sets], pa.binary())], ["class", "members"])

    return materialise(texts.select("class", "text").mapInArrow(run, "class bigint, members binary"), "jaccard-members")


def in_both(a: np.ndarray, b: np.ndarray) -> int:
    """Number of common values of two sorted arrays without repeats."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if not len(small):
        return 0
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    return int(np.count_nonzero(large[at] == small))


def verify(pairs: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """pairs (a, b) of classes -> those that are linked."""
    one = members.select(F.col("class").alias("a"), F.col("members").alias("of_a"))
    two = members.select(F.col("class").alias("b"), F.col("members").alias("of_b"))
    both = pairs.select("a", "b").join(one.hint("merge"), "a").join(two.hint("merge"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            yes = []
            for x, y in zip(t["of_a"], t["of_b"]):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                yes.append(linked(len(x), len(y), in_both(x, y), percent))
            yield batch.select(["a", "b"]).filter(pa.array(yes, pa.bool_()))

    return both.mapInArrow(run, "a bigint, b bigint")


FAR = np.iinfo(np.uint16).max


def distances(roots: np.ndarray, sizes: np.ndarray, sketches: list[bytes], tiles: np.ndarray, percent: int) -> np.ndarray:
    """Hamming distance of every two sets that the sketch does not rule out; FAR for the others, and for two of a component.

    Pairs lie across the two tiles given, if there are two.
    """
    raw = [np.frombuffer(s, np.uint8) for s in sketches]
    least = min(map(len, raw))
    # Folded to the least size, any two can be compared; sets that agree in a block have much the same size.
    m = np.stack([fold(r, least) for r in raw]).view(np.uint64)
    g, two = len(roots), len(np.unique(tiles)) > 1
    out = np.full((g, g), FAR, dtype=np.uint16)
    for i in range(g - 1):
        rest = slice(i + 1, None)
        maybe = roots[rest] != roots[i]
        if two:
            maybe &= tiles[rest] != tiles[i]
        # d <= (100 - p) / (100 + p) * (a + b), and the smaller at least p percent of the larger.
        total = sizes[rest] + sizes[i]
        maybe &= 100 * np.minimum(sizes[rest], sizes[i]) >= percent * np.maximum(sizes[rest], sizes[i])
        at = np.flatnonzero(maybe)
        if not len(at):
            continue
        d = np.bitwise_count(m[at + i + 1] ^ m[i]).sum(axis=1, dtype=np.int64)
        ok = d * (100 + percent) <= (100 - percent) * total[at]
        at = at[ok] + i + 1
        out[i, at] = out[at, i] = np.minimum(d[ok], FAR - 1)
    return out


def spanning_pairs(roots: np.ndarray, distance: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the components, closest pairs first (by Prim): at most one pair for each but one of them."""
    g = len(roots)
    near, by, open_, pairs = np.full(g, FAR, dtype=np.uint16), np.full(g, -1), np.ones(g, dtype=bool), []
    while open_.any():
        at = int(np.argmin(np.where(open_, near, FAR)))
        if not open_[at] or near[at] == FAR:
            at = int(np.flatnonzero(open_)[0])  # the next tree
        elif by[at] >= 0:
            pairs.append((int(by[at]), at))
        # The whole component comes in with the first of its classes.
        for k in np.flatnonzero(open_ & (roots == roots[at])):
            open_[k] = False
            closer = distance[k] < near
            near[closer], by[closer] = distance[k][closer], k
    return pairs


def linked_pairs(roots: np.ndarray, distance: np.ndarray, members: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Linked pairs that join two components, by comparing members; what other links join is joined already."""
    at = {r: i for i, r in enumerate(np.unique(roots).tolist())}
    parent = list(range(len(at)))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    i, j = np.nonzero(np.triu(distance != FAR, 1))
    order = np.argsort(distance[i, j], kind="stable")
    out = []
    for a, b in zip(i[order].tolist(), j[order].tolist()):
        x, y = find(at[int(roots[a])]), find(at[int(roots[b])])
        if x != y and linked(len(members[a]), len(members[b]), in_both(members[a], members[b]), percent):
            parent[x] = y
            out.append((a, b))
    return out


def _by_tile(rows: DataFrame, columns: list[str], kernel, schema: str) -> DataFrame:
    """``kernel`` over the rows of each (word, i, j), as lists of the columns; rows are dealt and sorted by tile."""
    dealt = rows.select("word", "i", "j", *columns).repartition("word", "i", "j").sortWithinPartitions("word", "i", "j", columns[0])
    names = [f.split()[0] for f in schema.split(", ")]
    kinds = {"bigint": pa.int64(), "int": pa.int32()}
    types = [kinds[f.split()[1]] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = [], None

        def flush():
            found = kernel(key, *zip(*held)) if len(held) > 1 else []
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*found), types)], names)

        for b in batches:
            for w, i, j, *row in zip(*[b.column(x).to_pylist() for x in range(b.num_columns)]):
                if (w, i, j) != key:
                    yield from flush()
                    held, key = [], (w, i, j)
                held.append(row)
        yield from flush()

    return dealt.mapInArrow(run, schema)


def mixed_tiles(held: DataFrame, classes: DataFrame, roots: DataFrame) -> DataFrame | None:
    """held (word, class), classes (class, n, sketch), roots (node, root) -> rows of the tiles of blocks that hold several
    components (word, i, j, class, root, n, sketch, tile), or None if there are none."""
    known = roots.select(F.col("node").alias("class"), "root")
    at = held.join(known, "class", "left").withColumn("root", F.coalesce("root", "class"))
    mixed = at.groupBy("word").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("g"))
    mixed = materialise(mixed.filter("lo <> hi").select("word", F.ceil(F.col("g") / F.lit(TILE)).cast("int").alias("t")), "jaccard-mixed")
    if mixed.isEmpty():
        return None
    rows = at.join(mixed, "word").join(classes.select("class", "n", "sketch").hint("merge"), "class")
    tile = F.pmod(F.xxhash64("class"), F.col("t")).cast("int")
    rows = rows.withColumn("tile", tile).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("t") - 1)))
    return rows.select("word", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"), "class", "root", "n", "sketch", "tile")


def _arrays(classes, roots, sizes, sketches, tiles) -> tuple:
    return np.array(classes), np.array(roots), np.array(sizes), list(sketches), np.array(tiles)


def tile_candidates(tiles: DataFrame, percent: int) -> DataFrame:
    """What the sketches leave of each tile: its classes that have a pair left (word, i, j, class, n, tile), and rows with a
    partner ``b`` as well for the pairs of a spanning forest; a written table."""
    def kernel(key, *columns):
        c, r, n, sketches, t = _arrays(*columns)
        d = distances(r, n, sketches, t, percent)
        left = np.flatnonzero((d != FAR).any(axis=1))
        return [(*key, int(c[k]), int(n[k]), int(t[k]), None) for k in left] + [
            (*key, int(min(c[a], c[b])), 0, 0, int(max(c[a], c[b]))) for a, b in spanning_pairs(r, d)]

    return materialise(_by_tile(tiles, ["class", "root", "n", "sketch", "tile"], kernel,
                                "word bigint, i int, j int, class bigint, n bigint, tile int, b bigint"), "jaccard-open")


def remaining_links(open_: DataFrame, roots: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Links a, b that join components; the classes of tiles that still hold several get their members.

    Classes that hang together by such tiles are one group, and meet there once, however many blocks they share; a group of more
    than TILE classes is compared tile by tile.  That two classes of a group share no block does no harm, as members are compared.
    """
    known = roots.select(F.col("node").alias("class"), "root")
    at = open_.join(known, "class", "left").withColumn("root", F.coalesce("root", "class"))
    mixed = at.groupBy("word", "i", "j").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.min("class").alias("hub")).filter("lo <> hi")
    left = at.join(mixed.select("word", "i", "j", "hub").hint("merge"), ["word", "i", "j"])
    left = materialise(left.select("class", "root", "n", "hub").distinct(), "jaccard-left")
    groups = connected_components(left.select(F.col("class").alias("a"), F.col("hub").alias("b")))
    one = left.select("class", "root", "n").distinct().join(groups.select(F.col("node").alias("class"), F.col("root").alias("word")), "class")
    sizes = one.groupBy("word").agg(F.ceil(F.count(F.lit(1)) / F.lit(TILE)).cast("int").alias("t"))
    rows = one.join(sizes, "word").withColumn("tile", F.pmod(F.xxhash64("class"), F.col("t")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("t") - 1)))
    rows = rows.select("word", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"), "class", "root", "n", "tile")
    both = rows.join(members.hint("merge"), "class")

    def kernel(key, c, r, n, t, raw):
        sets = [np.frombuffer(x, np.uint64) for x in raw]
        r = np.array(r)
        found = linked_pairs(r, distances(r, np.array(n), [bit_sketch(x).tobytes() for x in sets], np.array(t), percent), sets, percent)
        return [(min(c[a], c[b]), max(c[a], c[b])) for a, b in found]

    return _by_tile(both, ["class", "root", "n", "tile", "members"], kernel, "a bigint, b bigint").distinct()


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80
) -> DataFrame:
    """doc_id, row_key, n_shingles, component_id (least id of its component), stays (one row per component); one row
    per row of ``docs``."""
    if not 1 <= percent <= 100:
        raise ValueError("percent must be from 1 to 100")
    rows = sets_table(docs, id_col, text_col, shingle, percent)
    narrow = rows.select("node", "doc_id", "row_key", "n", "set_key")
    # A class is named by its least node; documents without shingles are classes of their own.
    by_key = materialise(narrow.filter("n > 0").groupBy("set_key").agg(F.min("node").alias("class")), "jaccard-classes")
    # Sides that grow with the corpus are merged at every size; no join turns into another kind as they grow.
    classes = rows.join(by_key.select(F.col("class").alias("node")).hint("merge"), "node", "left_semi")
    words = classes.select(F.explode("blocks").alias("word"), F.col("node").alias("class"))
    group = Window.partitionBy("word")
    held = words.withColumn("g", F.count(F.lit(1)).over(group)).withColumn("least", F.min("class").over(group))
    held = materialise(held.filter("g > 1"), "jaccard-held")

    closest = held.filter("class <> least").groupBy("class", "least").agg(F.count(F.lit(1)).alias("agree"))
    closest = closest.groupBy("class").agg(F.max(F.struct("agree", (-F.col("least")).alias("back"))).alias("best"))
    tried = materialise(closest.select((-F.col("best.back")).alias("a"), F.col("class").alias("b")), "jaccard-tried")
    involved = held.select("class").distinct().join(narrow.withColumnRenamed("node", "class"), "class").select(
        "class", F.col("doc_id").alias("of_id"), F.col("row_key").alias("of_row"))
    text = docs.select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("row_key"), F.col(text_col).alias("text"))
    texts = text.join(materialise(involved, "jaccard-involved").hint("merge"), F.col("id").eqNullSafe(F.col("of_id")) & (F.col("row_key") == F.col("of_row")))
    members = members_table(texts.groupBy("class").agg(F.first("text").alias("text")), shingle)

    sketches = rows.select(F.col("node").alias("class"), "n", "sketch").join(
        held.select("class").distinct().hint("merge"), "class", "left_semi")
    sketches = materialise(sketches, "jaccard-sketches")
    links = materialise(verify(tried, members, percent), "jaccard-links")
    roots = connected_components(links)
    tiles = mixed_tiles(held, sketches, roots)
    if tiles is not None:
        found = tile_candidates(tiles, percent)
        new = found.filter("b IS NOT NULL").select(F.col("class").alias("a"), "b").distinct().join(tried, ["a", "b"], "left_anti")
        links = links.unionByName(materialise(verify(materialise(new, "jaccard-tried"), members, percent), "jaccard-links"))
        roots = connected_components(links)
        more = materialise(remaining_links(found.filter("b IS NULL").drop("b"), roots, members, percent), "jaccard-links")
        links = links.unionByName(more)
        roots = roots if more.isEmpty() else connected_components(links)

    classed = narrow.filter("n > 0").join(by_key, "set_key").join(roots.withColumnRenamed("node", "class"), "class", "left")
    classed = classed.select("node", "doc_id", "row_key", "n", F.coalesce("root", "class").alias("root"))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "node")
    least = classed.groupBy("root").agg(F.min(order).alias("first"))
    out = classed.join(least, "root").select(
        "doc_id", "row_key", F.col("n").alias("n_shingles"), F.col("first.doc_id").alias("component_id"),
        (F.col("node") == F.col("first.node")).alias("stays"))
    alone = narrow.filter("n = 0").select("doc_id", "row_key", F.col("n").alias("n_shingles"),
                                          F.col("doc_id").alias("component_id"), F.lit(True).alias("stays"))
    return out.unionByName(alone)


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` with the document of the least id of each component, all columns as they were."""
    found = near_duplicates(docs, id_col, text_col, **how)
    kept = found.groupBy(F.col("doc_id").alias("id"), "row_key").agg(
        F.max("stays").alias("stays"), F.count(F.lit(1)).alias("times")).filter("stays")
    return keep_once(docs, materialise(kept, "jaccard-kept"), id_col, text_col)
