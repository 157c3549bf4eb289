"""SentencePiece encoding over a relational lattice, and decoding.

Texts fall into units that no piece crosses: a run of letters and signs with the
spaces before it. The ``DICTIONARY`` most frequent units of the corpus are encoded
once: their substrings up to the longest piece are exploded and joined to the
piece table, the edges found are grouped by unit, and a higher-order
``aggregate`` folds them.
For unigram models the fold is Viterbi's. A BPE model's best-scoring path is not
its encoding, so there the edges are folded in merge order: an edge is taken if
exactly two neighbouring symbols make it up. One pass suffices, because the
parts of a piece were learned before it. That does not hold for pieces that share
a score (runs of spaces); units with those, and units of more than ``LONG_UNIT``
characters, are merged from a heap of neighbouring pairs, in n log n steps.

The dictionary is shipped to the tasks that encode the documents. A task encodes
the units beyond it (a few in a hundred) by the same heap: sending every rare
unit to a table and back would move more than the documents.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigilseries.llm.arrays import _hash_words, cuts, flat, spans_hash
from vigilseries.llm.arrays import pieces as text_runs
from vigilseries.llm.quality import kth_largest
from vigilseries.llm.scratch import drop, store

SPACE = "▁"
DICTIONARY = 1 << 20
CACHE = 1 << 15
LONG_UNIT = 128
UNITS_A_TASK = 50_000
UNKNOWN_COST = 10.0


@dataclass
class Pieces:
    """A piece table: (piece, id, score) of the pieces that text can match, byte ids, and the kind of model."""

    rows: list[tuple[str, int, float]]
    byte_ids: list[int] | None
    unknown_id: int
    bpe: bool
    spelled: list[bytes] = field(repr=False)

    @property
    def lone_bytes(self) -> np.ndarray:
        """By byte, whether it is white space that no longer piece holds."""
        held = {c for p, _, _ in self.rows if len(p) > 1 for c in p}
        return np.array([0x09 <= b < 0x0E and chr(b) not in held for b in range(256)])

    @property
    def unit_pattern(self) -> str:
        """Units: spaces and what follows them; white space that no longer piece holds stands alone."""
        lone = "".join(f"\\x{b:02X}" for b in np.flatnonzero(self.lone_bytes))
        return f"{SPACE}*[^{SPACE}{lone}]+|{SPACE}+" + (f"|[{lone}]" if lone else "")

    @property
    def longest(self) -> int:
        return max((len(p) for p, _, _ in self.rows), default=1)

    def frame(self, spark: SparkSession) -> DataFrame:
        often = Counter(s for p, _, s in self.rows if len(p) > 1)
        rows = [(p, i, s, len(p) > 1 and often[s] > 1) for p, i, s in self.rows]
        return spark.createDataFrame(rows, "piece string, id int, score double, tied boolean")


def load_pieces(path: str) -> Pieces:
    """Read a model file. Only models that leave text as it is and keep spaces in front of words are taken."""
    from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2
    spec = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        spec.ParseFromString(f.read())
    norm, train = spec.normalizer_spec, spec.trainer_spec
    if norm.name != "identity" or not norm.add_dummy_prefix or norm.remove_extra_whitespaces or not norm.escape_whitespaces or train.treat_whitespace_as_suffix:
        raise ValueError("the model changes text before it is cut; only identity models with a space in front are supported")
    model = SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    plain = [i for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    rows = [(model.id_to_piece(i), i, float(model.get_score(i))) for i in plain]
    crossing = [p for p, _, _ in rows if len(p) > 1 and SPACE in p.lstrip(SPACE)]
    if crossing:
        raise ValueError(f"pieces cross unit borders: {crossing[:3]}")
    byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)] if train.byte_fallback else None
    spelled = [b"" if model.is_control(i) else bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i)
               else b" \xe2\x81\x87 " if model.is_unknown(i) else model.id_to_piece(i).replace(SPACE, " ").encode() for i in ids]
    return Pieces(rows, byte_ids, model.unk_id(), train.model_type == 2, spelled)


def units(text: Column, pieces: Pieces) -> Column:
    """The units of a text; none for null and empty texts."""
    spaced = F.concat(F.lit(SPACE), F.translate(text, " ", SPACE))
    return F.when(text.isNotNull() & (text != ""), F.regexp_extract_all(spaced, F.lit(pieces.unit_pattern), F.lit(0))).otherwise(F.array().cast("array<string>"))


def encode_units(each: DataFrame, pieces: Pieces) -> DataFrame:
    """``(unit, ids)`` for a frame of different, not empty ``unit`` strings."""
    return _folded(each, pieces).mapInArrow(_filler(pieces), "unit string, ids array<int>")


def _folded(each: DataFrame, pieces: Pieces) -> DataFrame:
    """``encode_units`` without the ids of the units that are merged in place; these are null.

    The longest piece bounds the substrings; the table, bounded by the
    vocabulary, is broadcast. All edges of a unit stay in the task of the unit.
    """
    n = each.count()
    dealt = each.select("unit").repartition(max(1 + n // UNITS_A_TASK, each.sparkSession.sparkContext.defaultParallelism), "unit")
    size = F.length("unit")
    # A long unit keeps one start only, so that it stays in the frame; its edges are not used.
    starts = dealt.select("unit", F.explode(F.when(size > LONG_UNIT, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), size - 1))).alias("lo"))
    reach = F.when(size > LONG_UNIT, F.lit(1)).otherwise(F.least(size, F.col("lo") + pieces.longest))
    spans = starts.select("unit", "lo", F.explode(F.sequence(F.col("lo") + 1, reach)).alias("hi"))
    cut = spans.withColumn("piece", F.substring("unit", F.col("lo") + 1, F.col("hi") - F.col("lo")))
    # Single characters without a piece stay as edges without an id.
    edges = cut.join(F.broadcast(pieces.frame(each.sparkSession)), "piece", "left").where("id IS NOT NULL OR hi = lo + 1")
    order = F.struct((-F.col("score")).alias("rank"), "lo", "hi", "id") if pieces.bpe else F.struct("hi", "lo", "score", "id")
    grouped = edges.groupBy("unit").agg(F.array_sort(F.collect_list(order)).alias("edges"),
                                         F.coalesce(F.bool_or("tied"), F.lit(False)).alias("tied"))
    in_place = (size > LONG_UNIT) | (F.col("tied") & F.lit(pieces.bpe))
    ends = _merge_fold() if pieces.bpe else _viterbi_fold(min((s for _, _, s in pieces.rows), default=0.0) - UNKNOWN_COST)
    # One pass over the grouped edges; what is merged in place leaves the expression null.
    folded = grouped.select("unit", F.when(~in_place, F.col("edges")).alias("edges")).select("unit", "edges", ends.alias("ends"))
    return folded.select("unit", F.when(F.col("edges").isNotNull(), _ids(pieces)).alias("ids"))


def _merge_fold() -> Column:
    """``ends[i]``: where the symbol that begins at i ends, 0 where none begins."""
    return F.expr("""aggregate(filter(edges, e -> e.hi > e.lo + 1), sequence(1, length(unit)), (ends, e) ->
        CASE WHEN ends[e.lo] > 0 AND ends[e.lo] < e.hi AND ends[ends[e.lo]] = e.hi
             THEN transform(ends, (x, i) -> CASE WHEN i = e.lo THEN e.hi WHEN i = ends[e.lo] THEN 0 ELSE x END)
             ELSE ends END)""")


def _viterbi_fold(unknown: float) -> Column:
    """The same array for the path of the largest score; edges come by end, then start, so their starts are settled."""
    best = f"""aggregate(edges, named_struct('s', concat(array(0D), transform(sequence(1, length(unit)), i -> -1e300D)), 'b', transform(sequence(0, length(unit)), i -> 0)),
        (st, e) -> CASE WHEN st.s[e.lo] + coalesce(e.score, {unknown}D) > st.s[e.hi]
             THEN named_struct('s', transform(st.s, (x, i) -> CASE WHEN i = e.hi THEN st.s[e.lo] + coalesce(e.score, {unknown}D) ELSE x END),
                               'b', transform(st.b, (x, i) -> CASE WHEN i = e.hi THEN e.lo ELSE x END)) ELSE st END).b"""
    walk = """aggregate(sequence(1, length(unit)), named_struct('at', length(unit), 'ends', transform(sequence(1, length(unit)), i -> 0)),
        (st, k) -> CASE WHEN st.at = 0 THEN st ELSE named_struct('at', back[st.at],
             'ends', transform(st.ends, (x, i) -> CASE WHEN i = back[st.at] THEN st.at ELSE x END)) END).ends"""
    return F.expr(f"transform(array({best}), back -> {walk})[0]")


def _ids(pieces: Pieces) -> Column:
    """Piece ids of the symbols; a character without a piece gives its bytes' ids, or the unknown id."""
    known = "filter(edges, e -> e.lo = i AND e.hi = ends[i])[0].id"
    if pieces.byte_ids:
        table = f"array({', '.join(map(str, pieces.byte_ids))})"
        spelled = "encode(substring(unit, i + 1, 1), 'utf-8')"
        other = f"transform(sequence(1, octet_length({spelled})), k -> {table}[CAST(conv(hex(substring({spelled}, k, 1)), 16, 10) AS INT)])"
    else:
        other = f"array({pieces.unknown_id})"
    return F.expr(f"""flatten(transform(filter(sequence(0, length(unit) - 1), i -> ends[i] > 0),
        i -> CASE WHEN {known} IS NOT NULL THEN array({known}) ELSE {other} END))""")


def _filler(pieces: Pieces):
    """Ids of the units that the expression left null; the others pass."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alone = InPlace(pieces)
        for batch in batches:
            ids = batch.column(1)
            if ids.null_count:
                made = [alone.ids(u) if x is None else x for u, x in zip(batch.column(0).to_pylist(), ids.to_pylist(), strict=True)]
                ids = pa.array(made, pa.list_(pa.int32()))
            yield pa.record_batch([batch.column(0), ids], ["unit", "ids"])
    return run


class InPlace:
    """Ids of one unit at a time, from the piece table, in about n log n steps for n characters."""

    def __init__(self, pieces: Pieces):
        self.pieces, self.id = pieces, {p: i for p, i, _ in pieces.rows}
        self.rank = {p: -s for p, _, s in pieces.rows if len(p) > 1 or not pieces.bpe}
        self.most, self.longest, self.cache = UNKNOWN_COST - min((s for _, _, s in pieces.rows), default=0.0), pieces.longest, {}

    def ids(self, unit: str) -> list[int]:
        found = self.cache.get(unit)
        if found is None:
            if len(self.cache) >= CACHE:
                self.cache.clear()
            ends = self.merged(unit) if self.pieces.bpe else self.best_path(unit)
            found, lo = [], 0
            while lo < len(unit):
                piece = self.id.get(unit[lo: ends[lo]])
                found += [piece] if piece is not None else [self.pieces.byte_ids[b] for b in unit[lo].encode()] if self.pieces.byte_ids else [self.pieces.unknown_id]
                lo = ends[lo]
            if len(unit) <= LONG_UNIT:
                self.cache[unit] = found
        return found

    def merged(self, unit: str) -> list[int]:
        """``ends[i]``: where the symbol that begins at i ends. The pair of the best score is merged first, the leftmost of equal ones."""
        n, rank, longest = len(unit), self.rank, self.longest
        ends, before = list(range(1, n + 1)), list(range(-1, n))
        heap = [(r, lo, lo + 2) for lo in range(n - 1) if (r := rank.get(unit[lo: lo + 2])) is not None]
        heapify(heap)
        while heap:
            _, lo, hi = heappop(heap)
            mid = ends[lo]
            if not 0 < mid < hi or ends[mid] != hi:
                continue  # one of the two has been merged with another since
            ends[lo], ends[mid], before[hi] = hi, 0, lo
            if hi < n and ends[hi] - lo <= longest and (r := rank.get(unit[lo: ends[hi]])) is not None:
                heappush(heap, (r, lo, ends[hi]))
            if lo and hi - before[lo] <= longest and (r := rank.get(unit[before[lo]: hi])) is not None:
                heappush(heap, (r, before[lo], hi))
        return ends

    def best_path(self, unit: str) -> list[int]:
        """The same for the path of the largest score; the longer last piece of equal ones."""
        n, rank = len(unit), self.rank
        cost, back = [0.0] + [float("inf")] * n, [0] * (n + 1)
        for hi in range(1, n + 1):
            for lo in range(max(0, hi - self.longest), hi):
                r = rank.get(unit[lo:hi], self.most if hi == lo + 1 else None)
                if r is not None and cost[lo] + r < cost[hi]:
                    cost[hi], back[hi] = cost[lo] + r, lo
        ends, at = [0] * n, n
        while at:
            ends[back[at]], at = at, back[at]
        return ends


def encode(docs: DataFrame, pieces: Pieces, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` and ``ids``, as the library encodes without begin and end marks.

    Null and empty texts get an empty list. Rows may repeat ids or have none.
    A column ``ids`` of ``docs`` is replaced.
    """
    docs = docs.drop("ids")
    each = docs.select(F.explode(units(F.col(text_col), pieces)).alias("unit"))
    # Equal counts are told apart by a hash, so that the dictionary stays within its bound.
    weight = F.col("n") + (F.xxhash64("unit").bitwiseAND(F.lit((1 << 40) - 1)) / F.lit(float(1 << 40)))
    seen = store(each.groupBy("unit").agg(F.count(F.lit(1)).alias("n")).select("unit", weight.alias("w")), "units")
    least = kth_largest(seen, "w", DICTIONARY)
    frequent = store(seen.where(F.col("w") >= F.lit(float(least))).select("unit"), "frequent")
    shared = docs.sparkSession.sparkContext.broadcast((*_packed(frequent, pieces), pieces))
    drop(seen, frequent)
    schema = T.StructType([*docs.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return docs.mapInArrow(_assembler(shared, docs.columns.index(text_col)), schema)


def _packed(frequent: DataFrame, pieces: Pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted unit hashes, and the ids of each; one binary row per batch reaches the driver, bounded by ``DICTIONARY``."""
    fill = _filler(pieces)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Filled in the same worker: two Python steps in a row would keep two workers per core.
        for batch in fill(batches):
            if batch.num_rows:
                ids = batch.column(1)
                counts = np.diff(ids.offsets.to_numpy()).astype(np.uint32)
                flat_ids = ids.flatten().to_numpy().astype(np.uint32)
                yield pa.record_batch([pa.array([x.tobytes()], pa.binary()) for x in (_unit_keys(batch.column(0)), counts, flat_ids)], ["k", "c", "i"])
    # Written by all tasks at once; the result is read in one job.
    packed = store(_folded(frequent, pieces).mapInArrow(pack, "k binary, c binary, i binary"), "packed")
    rows = packed.collect()
    drop(packed)
    if not rows:
        return np.zeros(0, np.uint64), np.zeros(1, np.uint8), np.zeros(0, np.uint8)
    key, count, ids = (np.concatenate([np.frombuffer(r[name], kind) for r in rows]) for name, kind in (("k", np.uint64), ("c", np.uint32), ("i", np.uint32)))
    del rows
    # Small types, as the driver and every Python worker hold a copy.
    ids = ids.astype(np.min_scalar_type(ids.max(initial=0)))
    small = np.min_scalar_type(-1 - len(ids))
    order, first = np.argsort(key), np.concatenate([[0], np.cumsum(count, dtype=small)]).astype(small)
    count = count[order]
    sorted_first = np.concatenate([[0], np.cumsum(count, dtype=small)]).astype(small)
    index = np.repeat(first[order] - sorted_first[:-1], count)
    index += np.arange(len(index), dtype=small)
    return key[order], sorted_first, ids[index]


def _unit_keys(column: pa.Array) -> np.ndarray:
    out = []
    for lo, hi in cuts(column, 1 << 20):
        data, offsets = flat(column.slice(lo, hi - lo))
        out.append(spans_hash(data, offsets[:-1], offsets[1:]))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


def _list(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    offsets = column.offsets.to_numpy().astype(np.int64)
    return column.values.slice(offsets[0], offsets[-1] - offsets[0]), offsets - offsets[0]


def cut_units(column: pa.Array, lone: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The units of ``units`` as byte ranges: spaced bytes, starts, ends, and the first unit of each text."""
    raw, offsets = flat(column)
    full = np.diff(offsets) > 0
    data = np.insert(raw, offsets[:-1][full], 0x20)
    offsets = offsets + np.concatenate([[0], np.cumsum(full)])
    space = np.flatnonzero(data == 0x20)
    data = np.repeat(data, np.where(data == 0x20, 3, 1).astype(np.uint8))
    at = space + 2 * np.arange(len(space))
    for k, byte in enumerate(SPACE.encode()):
        data[at + k] = byte
    offsets = offsets + 2 * np.searchsorted(space, offsets)
    # Bytes of the sign for a space (also where the text has it), of lone white space, and others.
    kind = np.where(lone[data], 2, 0).astype(np.uint8)
    marks = np.flatnonzero((data[:-2] == 0xE2) & (data[1:-1] == 0x96) & (data[2:] == 0x81)) if len(data) > 2 else np.zeros(0, np.int64)
    for k in range(3):
        kind[marks + k] = 1
    new = (kind == 2) | (np.diff(kind, prepend=kind[:1]) != 0)
    new[1:] &= ~((kind[1:] == 0) & (kind[:-1] == 1))
    new[offsets[:-1][full]] = True
    starts = np.flatnonzero(new)
    return data, starts, np.append(starts[1:], len(data)), np.searchsorted(starts, offsets)


def _assembler(shared, where: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, first, table, pieces = shared.value
        lone, beyond = pieces.lone_bytes, InPlace(pieces)
        for batch in batches:
            at = 0
            for texts in text_runs(batch.column(where), 1 << 20):
                part = batch.slice(at, len(texts))
                at += len(texts)
                data, starts, ends, owner = cut_units(texts, lone)
                place = _find(keys, _hash_words(data, starts, ends))
                known = place >= 0
                size = np.zeros(len(place), np.int64)
                size[known] = first[place[known] + 1].astype(np.int64) - first[place[known]]
                made: list[int] = []
                for k, lo, hi in zip(*(x[~known].tolist() for x in (np.arange(len(place)), starts, ends)), strict=True):
                    found = beyond.ids(data[lo:hi].tobytes().decode())
                    made += found
                    size[k] = len(found)
                total = np.concatenate([[0], np.cumsum(size)])
                looked_up = np.repeat(known, size)
                values = np.empty(total[-1], np.int32)
                values[~looked_up] = made
                begin = (first[place[known]].astype(np.int64) - total[:-1][known]).repeat(size[known])
                values[looked_up] = table[np.flatnonzero(looked_up) + begin]
                ids = pa.ListArray.from_arrays(pa.array(total[owner].astype(np.int32)), pa.array(values))
                yield pa.RecordBatch.from_arrays([*part.columns, ids], [*part.schema.names, "ids"])
    return run


def _row_cuts(column: pa.Array, limit: int = 1 << 18) -> Iterator[tuple[int, int]]:
    """Runs of rows with about ``limit`` units."""
    offsets, lo = column.offsets.to_numpy(), 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        yield lo, hi
        lo = hi


def decode(docs: DataFrame, pieces: Pieces, ids_col: str = "ids", name: str = "decoded") -> DataFrame:
    """All rows and columns and the text of the ids, as the library decodes.

    The space in front is taken off; ids without a piece give nothing; byte
    pieces that are not UTF-8 give the replacement character. A null list gives
    null. A column called ``name`` is replaced.
    """
    docs = docs.drop(name)
    shared = docs.sparkSession.sparkContext.broadcast(pieces.spelled)
    where = docs.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelled = shared.value
        size = np.array([len(x) for x in spelled] + [0], np.int64)
        first = np.concatenate([[0], np.cumsum(size)])
        pool = np.frombuffer(b"".join(spelled) or b"\0", np.uint8)
        for batch in batches:
            for lo, hi in _row_cuts(batch.column(where)):
                part = batch.slice(lo, hi - lo)
                values, offsets = _list(part.column(where))
                ids = values.fill_null(-1).to_numpy().astype(np.int64)
                ids = np.where((ids < 0) | (ids >= len(spelled)), len(spelled), ids)
                ends = np.concatenate([[0], np.cumsum(size[ids])])
                data = pool[np.arange(ends[-1]) + np.repeat(first[ids] - ends[:-1], size[ids])].tobytes()
                text = [data[a:b].decode(errors="replace").removeprefix(" ") for a, b in zip(ends[offsets[:-1]], ends[offsets[1:]], strict=True)]
                made = pa.array(text, pa.string(), mask=part.column(where).is_null().to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays([*part.columns, made], [*part.schema.names, name])
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.StringType())]))
