"""SentencePiece encoding by a relational lattice, and decoding.

Texts are cut into words that no piece reaches across. A word becomes a lattice of
edges, and a fold over them keeps the best way to each place. Frequent words become
lattices in tables, once, and are broadcast: every substring up to the longest piece is
joined to the pieces, and the edges are gathered per word. The other words of a text stay
in its row: their edges come from a walk over the pieces' letters, a batch of texts at a
time, and Spark folds them there, so no row is made for a substring.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.llm.common import settle

SPACE = "▁"
_MOST_PIECES = 1_000_000
# Characters below which a word is folded by Spark. The fold copies its state at
# each step; longer words take a loop over the same lattice in Python.
_FOLD_BELOW = 200
# Frequent words are shorter than this.
_SHARED_BELOW = 64
# Rows, each a whole text, that Spark hands to a Python worker at a time.
_ROWS_AT_ONCE = 1000
# Counts of words that a task holds.
_COUNTED_AT_ONCE = 1 << 20
_UNKNOWN_PENALTY = 10.0  # below the lowest score, as the format defines it


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with their scores; ``byte_ids`` are those that spell unknown characters."""

    pieces: list[tuple[int, str, float]]
    byte_ids: list[int]
    texts: list[bytes]
    lowest: float
    longest: int
    cut_before: str

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        """Read a model file on the driver; it is bounded by ``_MOST_PIECES``."""
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        rules, trainer = model.normalizer_spec, model.trainer_spec
        if len(model.pieces) > _MOST_PIECES:
            raise ValueError(f"more than {_MOST_PIECES} pieces")
        if (rules.precompiled_charsmap or not rules.add_dummy_prefix
                or rules.remove_extra_whitespaces or not trainer.byte_fallback):
            raise ValueError("only models that keep the text and spell unknown characters")
        kinds = type(model.pieces[0])
        plain = [(i, p.piece, p.score) for i, p in enumerate(model.pieces)
                 if p.type in (kinds.NORMAL, kinds.USER_DEFINED, kinds.UNUSED)]
        texts = [b"" if p.type in (kinds.CONTROL, kinds.UNKNOWN)
                 else bytes([int(p.piece[3:5], 16)]) if p.type == kinds.BYTE
                 else p.piece.encode() for p in model.pieces]
        lowest = min(score for _, _, score in plain)
        if any(SPACE in piece.lstrip(SPACE) for _, piece, _ in plain):
            raise ValueError("pieces that reach across words are not supported")
        # Punctuation that never follows a letter inside a piece starts a word of its own.
        joined = {piece[i] for _, piece, _ in plain for i in range(1, len(piece))
                  if piece[i - 1].isalpha()}
        return cls(
            plain, [i for i, p in enumerate(model.pieces) if p.type == kinds.BYTE], texts, lowest,
            max(len(piece) for _, piece, _ in plain),
            "".join(c for c in ".,;:!?|" if c not in joined),
        )

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.pieces, "id int, piece string, score double")


def _after_letters(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether a letter ends before each of some places in valid UTF-8."""
    before = data[at - 1]
    letter = np.array([chr(code).isalpha() for code in range(128)] + [False] * 128)[before]
    wide = np.flatnonzero(before >= 0x80)
    place, code = at[wide] - 1, np.zeros(len(wide), np.int64)
    rest, shift = np.arange(len(wide)), 0
    while len(rest):
        # Bytes that go on hold six bits each, a first byte what its mark leaves.
        byte = data[place[rest]].astype(np.int64)
        on = byte & 0xC0 == 0x80
        own = np.where(on, 0x3F, np.where(byte >= 0xF0, 0x07, np.where(byte >= 0xE0, 0x0F, 0x1F)))
        code[rest] |= (byte & own) << shift
        rest, shift = rest[on], shift + 6
        place[rest] -= 1
    codes, which = np.unique(code, return_inverse=True)
    letter[wide] = np.array([chr(own).isalpha() for own in codes.tolist()], bool)[which]
    return letter


def words_of(texts: pa.Array, vocabulary: Vocabulary) -> pa.ListArray:
    """The words of each text, in order; none for empty texts. Texts are valid UTF-8, not null."""
    begun = pc.if_else(pc.equal(pc.binary_length(texts), 0), "", " ")
    marked = pc.replace_substring(pc.binary_join_element_wise(begun, texts, ""), " ", SPACE)
    size = pc.binary_length(marked).to_numpy().astype(np.int64)
    offsets, held = np.concatenate(([0], np.cumsum(size))), marked.buffers()[2]
    if not offsets[-1]:
        return pa.array([[]] * len(texts), pa.list_(pa.string()))
    data = np.frombuffer(held, np.uint8)[: offsets[-1]]
    space, marks = SPACE.encode(), np.zeros(256, bool)
    marks[list(vocabulary.cut_before.encode())] = True
    looked = marks.copy()
    looked[space[0]] = True
    at = np.flatnonzero(np.frombuffer(data.tobytes().translate(looked.tobytes()), bool))
    byte = data[at]
    is_space = byte == space[0]
    own = at[is_space]
    is_space[is_space] = (data[own + 1] == space[1]) & (data[own + 2] == space[2])
    cut = np.zeros(len(at), bool)
    spaces = np.flatnonzero(is_space)
    # A run of spaces starts a word, and so does each text.
    cut[spaces] = np.diff(at[spaces], prepend=-9) != len(space)
    cut[np.searchsorted(at, offsets[:-1][size > 0])] = True
    stops = np.flatnonzero(marks[byte])
    cut[stops] = _after_letters(data, at[stops])
    begins = at[cut]
    words = pa.Array.from_buffers(pa.string(), len(begins), [
        None, pa.py_buffer(np.append(begins, offsets[-1]).astype(np.int32)), held])
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(begins, offsets).astype(np.int32)), words)


def edges(words: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """The rows of ``words`` once for every ``edge`` of their ``word``, a piece at a place.

    Every substring of up to the longest piece is exploded and joined to the pieces. A
    character that is no piece has an edge of its own, its number a negative one. A row
    whose word is null stays, with a null edge.
    """
    size = F.length("word")
    columns = words.columns
    # Two plain generators, so that nothing but numbers is made before the substring.
    started = words.select(
        *columns, F.explode_outer(F.sequence(F.lit(0), size - 1)).alias("start"))
    longest = F.least(F.col("start") + vocabulary.longest, size)
    ended = started.select(*columns, "start", F.explode_outer(
        F.sequence(F.col("start") + 1, longest)).alias("end"))
    parts = ended.select(*columns, "start", "end", F.substr(
        "word", F.col("start") + 1, F.col("end") - F.col("start")).alias("piece"))
    # The pieces are bounded by the vocabulary's file, whatever the texts.
    known = F.broadcast(vocabulary.table(words.sparkSession))
    unknown = F.lit(vocabulary.lowest - _UNKNOWN_PENALTY)
    edge = F.struct(
        (F.col("end") * 256 + F.col("start")).alias("place"),
        F.coalesce("id", -F.ascii("piece") - 1).alias("id"),
        F.coalesce("score", unknown).alias("score"),
    )
    return parts.join(known, "piece", "left").where(
        "id IS NOT NULL OR end = start + 1 OR word IS NULL"
    ).select(*columns, F.when(F.col("word").isNotNull(), edge).alias("edge"))


def _best_ids(lattice: Column, size: Column) -> Column:
    """Fold sorted edges into the best way to each place, then walk back from the end."""
    origin = F.array(F.struct(F.lit(0.0).alias("score"), F.lit(0).alias("start"),
                              F.lit(0).alias("id")))

    def step(ways: Column, edge: Column) -> Column:
        start, at = edge["place"].bitwiseAND(F.lit(255)), F.shiftright(edge["place"], 8)
        score = F.element_at(ways, start + 1)["score"] + edge["score"]
        way = F.array(F.struct(score.alias("score"), start.alias("start"), edge["id"].alias("id")))
        return (
            F.when(F.size(ways) == at, F.concat(ways, way))
            # Of equal ways the one whose last piece starts first, which came first, stays.
            .when(score > F.element_at(ways, -1)["score"], F.concat(F.slice(ways, 1, at), way))
            .otherwise(ways)
        )

    def back(state: Column, place: Column) -> Column:
        way = F.element_at(state["ways"], place + 1)
        return F.when(state["at"] == place, F.struct(
            way["start"].alias("at"), F.concat(F.array(way["id"]), state["ids"]).alias("ids"),
            state["ways"].alias("ways"))).otherwise(state)

    return F.aggregate(
        F.sequence(size, F.lit(1), F.lit(-1)),
        F.struct(size.alias("at"), F.array().cast("array<int>").alias("ids"),
                 F.aggregate(lattice, origin, step).alias("ways")),
        back, lambda state: state["ids"],
    )


def _best_ids_by_end(lattice: Column) -> Column:
    """The same where the edges to each place are an array, by their starts.

    The fold keeps no more than the best score of each place, a number. On the way back an
    edge that reaches it is looked for, only at the places that the best way has.
    """
    def reached(scores: Column, edge: Column) -> Column:
        return F.get(scores, edge["start"]) + edge["score"]

    def step(scores: Column, edges: Column) -> Column:
        return F.array_append(scores, F.array_max(F.transform(edges, lambda edge: reached(scores, edge))))

    def ids(scores: Column) -> Column:
        def back(state: Column, place: Column) -> Column:
            # Of equal ways the one whose last piece starts first comes first.
            best = F.filter(F.get(lattice, place - 1), lambda edge: reached(scores, edge) == F.get(scores, place))
            return F.when(state["at"] == place, F.get(F.transform(best, lambda edge: F.struct(
                edge["start"].alias("at"), F.array_append(state["ids"], edge["id"]).alias("ids"))), F.lit(0)),
            ).otherwise(state)

        return F.aggregate(
            F.sequence(F.size(lattice), F.lit(1), F.lit(-1)),
            F.struct(F.size(lattice).alias("at"), F.array().cast("array<int>").alias("ids")),
            back, lambda state: F.reverse(state["ids"]))

    # An array of one, so that the scores are folded once for all places of the way back.
    return F.get(F.transform(F.array(F.aggregate(lattice, F.array(F.lit(0.0)), step)), ids), F.lit(0))


def encode_words(words: DataFrame, keys: list[str], vocabulary: Vocabulary) -> DataFrame:
    """``ids`` for each row of ``words``, told apart by ``keys``; its ``word`` may be null.

    Words are of fewer than ``_FOLD_BELOW`` characters. Where the rows are dealt by some
    of the keys, exploding them and meeting the broadcast pieces leaves them where
    they are, and the edges are gathered without a shuffle. Negative ids stand for
    characters that are no piece: one less than minus their code point.
    """
    sized = words.withColumn("_size", F.length("word"))
    kept = [c for c in sized.columns if c != "word" and c not in keys]
    # The word itself is not carried along, unless it is a key.
    gathered = edges(sized, vocabulary).select(*keys, *kept, "edge").groupBy(*keys).agg(
        *[F.first(c, ignorenulls=True).alias(c) for c in kept],
        F.sort_array(F.collect_list("edge")).alias("_edges"))
    length = F.col("_size")
    return gathered.withColumn(
        "ids", F.when(length > 0, _best_ids(F.col("_edges"), length))
    ).drop("_edges", "_size")


@dataclass(frozen=True)
class _Walk:
    """The pieces as a tree of letters: a step from a node is one number, kept by its hash."""

    steps: np.ndarray
    to: np.ndarray
    ids: np.ndarray
    scores: np.ndarray
    unknown: float
    longest: int

    @classmethod
    def of(cls, vocabulary: Vocabulary) -> _Walk:
        nodes: dict[int, int] = {}
        ends: dict[int, tuple[int, float]] = {}
        for number, piece, score in vocabulary.pieces:
            node = 0
            for letter in piece:
                node = nodes.setdefault(node << 21 | ord(letter), len(nodes) + 1)
            ends[node] = number, score
        places = 1 << (4 * len(nodes) + 1).bit_length()
        steps, to = np.full(places, -1, np.int64), np.zeros(places, np.int64)
        for step, at in zip(nodes, cls._places(np.array(list(nodes), np.int64), places).tolist()):
            while steps[at] >= 0:
                at = (at + 1) % places
            steps[at], to[at] = step, nodes[step]
        ids, scores = np.full(len(nodes) + 1, -1, np.int32), np.zeros(len(nodes) + 1)
        for node, (number, score) in ends.items():
            ids[node], scores[node] = number, score
        return cls(steps, to, ids, scores, vocabulary.lowest - _UNKNOWN_PENALTY, vocabulary.longest)

    @staticmethod
    def _places(steps: np.ndarray, places: int) -> np.ndarray:
        mixed = steps.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(65 - places.bit_length())).astype(np.int64)

    def _found(self, steps: np.ndarray) -> np.ndarray:
        """The place of each step in the table, that of an empty one if it is in no piece."""
        at = self._places(steps, len(self.steps))
        held = self.steps[at]
        left = np.flatnonzero((held != steps) & (held >= 0))
        while len(left):
            at[left] = (at[left] + 1) % len(self.steps)
            held = self.steps[at[left]]
            left = left[(held != steps[left]) & (held >= 0)]
        return at

    def lattices(self, words: list[str] | pa.StringArray) -> pa.ListArray:
        """For each word and place in it the edges that end there, those that ``edges`` joins."""
        words = pa.array(words, pa.string())
        sizes = pc.utf8_length(words).to_numpy().astype(np.int64)
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), "")
        letters = np.frombuffer(joined[0].as_py().encode("utf-32-le"), np.uint32).astype(np.int64)
        begins = np.repeat(np.cumsum(sizes) - sizes, sizes)
        stops = begins + np.repeat(sizes, sizes)
        start, node = np.arange(len(letters)), np.zeros(len(letters), np.int64)
        single = np.zeros(len(letters), bool)
        starts, ends, ids, scores = [], [], [], []
        for length in range(1, self.longest + 1):
            step = node << 21 | letters[start + length - 1]
            at = self._found(step)
            known = self.steps[at] == step
            start, node = start[known], self.to[at[known]]
            whole = self.ids[node] >= 0
            if length == 1:
                single[start[whole]] = True
            starts.append(start[whole])
            ends.append(start[whole] + length)
            ids.append(self.ids[node[whole]])
            scores.append(self.scores[node[whole]])
            further = start + length < stops[start]
            start, node = start[further], node[further]
            if not len(start):
                break
        other = np.flatnonzero(~single)
        starts.append(other)
        ends.append(other + 1)
        ids.append((-letters[other] - 1).astype(np.int32))
        scores.append(np.full(len(other), self.unknown))
        many = np.bincount(np.concatenate(ends), minlength=len(letters) + 1)
        of_place = np.cumsum(many)
        free = of_place - many
        count = of_place[-1]
        by_start, by_id, by_score = np.empty(count, np.int32), np.empty(count, np.int32), np.empty(count)
        # The longest first: so the edges to a place come by their starts.
        for start, end, own, score in reversed(list(zip(starts, ends, ids, scores))):
            at = free[end]
            free[end] += 1
            by_start[at], by_id[at], by_score[at] = start - begins[start], own, score
        edge = pa.StructArray.from_arrays(
            [pa.array(by_start), pa.array(by_id), pa.array(by_score)], ["start", "id", "score"])
        by_end = pa.ListArray.from_arrays(pa.array(of_place.astype(np.int32)), edge)
        return pa.ListArray.from_arrays(
            pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)), by_end)


def _plain_ids(word: str, by_piece: dict[str, tuple[int, float]], vocabulary: Vocabulary) -> list:
    """The same for one long word, in time proportional to its length."""
    n = len(word)
    best, came = [0.0] + [None] * n, [None] * (n + 1)
    for start in range(n):
        for end in range(start + 1, min(n, start + vocabulary.longest) + 1):
            known = by_piece.get(word[start:end])
            if known:
                ids, score = [known[0]], best[start] + known[1]
            elif end == start + 1:
                ids = [vocabulary.byte_ids[b] for b in word[start].encode()]
                score = best[start] + vocabulary.lowest - _UNKNOWN_PENALTY
            else:
                continue
            if best[end] is None or score > best[end]:
                best[end], came[end] = score, (start, ids)
    parts, at = [], n
    while at:
        at, ids = came[at]
        parts.append(ids)
    return [i for ids in reversed(parts) for i in ids]


def _spelled(ids: list[int], vocabulary: Vocabulary) -> list[int]:
    """Ids with bytes in place of characters that are no piece."""
    if min(ids, default=0) >= 0:
        return ids
    return [b for i in ids for b in (
        [i] if i >= 0 else [vocabulary.byte_ids[x] for x in chr(-i - 1).encode()])]


def _with_bytes(ids: np.ndarray, size: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, ...]:
    """Where the lists of words that stand one after the other begin, their sizes, and their ids.

    Words with a character that is no piece get its bytes, behind all others.
    """
    first, size = np.cumsum(size) - size, size.copy()
    owner = np.repeat(np.arange(len(size)), size)
    added: list[int] = []
    for word in np.unique(owner[ids < 0]).tolist():
        own = _spelled(ids[first[word] : first[word] + size[word]].tolist(), vocabulary)
        first[word], size[word] = len(ids) + len(added), len(own)
        added += own
    return first, size, np.concatenate((ids, np.array(added, np.int32)))


def _text(ids: list[int], vocabulary: Vocabulary) -> bytes:
    known = len(vocabulary.texts)
    return _spaced(b"".join([vocabulary.texts[i] for i in ids if 0 <= i < known]))


def _spaced(spelled: bytes) -> bytes:
    return spelled.replace(SPACE.encode(), b" ").removeprefix(b" ")


def decode(encoded: DataFrame, vocabulary: Vocabulary, ids: str = "ids") -> DataFrame:
    """``encoded`` with the ``text`` of its ids, the space at its start left out.

    Characters that were spelled in bytes come back. Unknown and control ids have no
    text, nor have ids outside the vocabulary or null ones; null for ``ids`` gives null, and so
    do bytes that are no text.
    """
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary)

    @F.arrow_udf("binary")
    def texts(lists: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for many in lists:
            yield pa.array(
                (None if own.as_py() is None else _text([i for i in own.as_py() if i is not None], shared.value)
                 for own in many), pa.binary())

    spelled = texts(F.col(ids).cast("array<int>"))
    return encoded.withColumn("text", F.when(F.is_valid_utf8(spelled.cast("string")), spelled.cast("string")))


@dataclass(frozen=True)
class _Shared:
    """Ids of the frequent words, one list after the other."""

    names: pa.Array
    first: np.ndarray
    size: np.ndarray
    ids: np.ndarray


def _counted(texts: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``(word, n)``, counted where the texts are read; words a task sees once are left out.

    It only has to find words that are worth sharing, so it need not be exact: a task
    sends on what it has when that is too much to hold.
    """

    def summed(held: list[pa.Table]) -> pa.Table:
        whole = pa.concat_tables(held).group_by("word").aggregate([("n", "sum")])
        return pa.table([whole.column("word"), whole.column("n_sum")], ["word", "n"])

    def often(found: pa.Table) -> list[pa.RecordBatch]:
        return found.filter(pc.greater(found.column("n"), 1)).combine_chunks().to_batches()

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            found = pc.value_counts(words_of(batch.column(0), vocabulary).flatten())
            part = pa.table([found.field("values"), found.field("counts")], ["word", "n"])
            part = part.filter(pc.less(pc.utf8_length(part.column("word")), _SHARED_BELOW))
            held.append(part)
            rows += len(part)
            if rows >= _COUNTED_AT_ONCE:
                held = [summed(held)]
                rows = len(held[0])
                if rows >= _COUNTED_AT_ONCE // 2:
                    yield from often(held[0])
                    held, rows = [], 0
        if held:
            yield from often(summed(held))

    return texts.select(F.make_valid_utf8("text")).mapInArrow(of_batches, "word string, n bigint").groupBy("word").agg(
        F.sum("n").alias("n"))


def _frequent(known: DataFrame, most: int) -> DataFrame:
    """The most frequent words, no more than ``most``.

    All words of a count go in or none; counts from 1000 on go by powers of two.
    """
    step = F.when(F.col("n") < 1000, F.col("n")).otherwise(1000 + F.floor(F.log2("n")))
    steps = known.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("words"))
    least, total = 2000, 0
    for r in sorted(steps.collect(), key=lambda r: -r.step):  # 1,064 rows at most
        total += r.words
        if total > most:
            break
        least = r.step
    return known.where(step >= least).select("word")


def _shared(texts: DataFrame, vocabulary: Vocabulary, most: int) -> _Shared:
    counted = settle(_counted(texts, vocabulary), "word-counts")
    # Dealt by word here, so that its edges stay together.
    dealt = _frequent(counted, most).repartition("word")
    found = settle(encode_words(dealt, ["word"], vocabulary), "frequent-words").toArrow()
    found = found.combine_chunks()
    if not len(found):
        return _Shared(pa.array([], pa.string()), *[np.zeros(0, np.int64)] * 2, np.zeros(0, np.int32))
    names, lists = (found.column(c).chunk(0) for c in ("word", "ids"))
    ids, size = lists.flatten().to_numpy(), np.diff(lists.offsets.to_numpy()).astype(np.int64)
    return _Shared(names, *_with_bytes(ids, size, vocabulary))


def _ragged(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Places of many stretches, one after the other."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - size), size)


def _looked_up(words: pa.ListArray, shared: _Shared, by_piece: dict, vocabulary: Vocabulary,
               walk: _Walk) -> pa.Array:
    """Ids of each row's words, compressed, and lattices of the words that are not shared, in order.

    In the ids the k-th of these stands as ``-k``, counted from 1. Words too long for the
    fold get their ids here. A word is looked up and walked once for all rows.
    """
    coded = words.flatten().dictionary_encode()
    names, code = coded.dictionary, coded.indices.to_numpy()
    ends = words.offsets.to_numpy().astype(np.int64)
    ends = ends - ends[0]
    # Asked the other way round, as a table of all shared words would be built anew each time.
    held = pc.index_in(shared.names, value_set=names)
    at = np.full(len(names), len(shared.names))
    at[held.drop_null().to_numpy()] = np.flatnonzero(held.is_valid().to_numpy(zero_copy_only=False))
    first, size = np.append(shared.first, 0)[at], np.append(shared.size, 1)[at]
    other = np.flatnonzero(at == len(shared.names))
    words_left = names.take(pa.array(other))
    long = pc.utf8_length(words_left).to_numpy() >= _FOLD_BELOW
    lattice = np.full(len(names), -1)
    lattice[other[~long]] = np.arange(len(other) - long.sum())
    added = []
    for name in other[long].tolist():
        own = _plain_ids(names[name].as_py(), by_piece, vocabulary)
        first[name], size[name] = len(shared.ids) + len(added), len(own)
        added += own
    gaps = np.flatnonzero(lattice[code] >= 0)
    row = np.searchsorted(ends, gaps, side="right") - 1
    in_row, which = np.unique(row * len(names) + code[gaps], return_inverse=True)
    rare_ends = np.searchsorted(in_row, np.arange(len(words) + 1) * len(names))
    numbers = np.arange(len(in_row)) - np.repeat(rare_ends[:-1], np.diff(rare_ends)) + 1
    first, size = first[code], size[code]
    first[gaps] = len(shared.ids) + len(added) + which
    ids = np.concatenate((shared.ids, np.array(added, np.int32), -numbers.astype(np.int32)))[_ragged(first, size)]
    running = np.concatenate(([0], np.cumsum(size)))
    packed = zstandard.ZstdCompressor(level=1)
    return pa.StructArray.from_arrays([
        pa.array([packed.compress(ids[a:b].tobytes())
                  for a, b in zip(running[ends[:-1]], running[ends[1:]])], pa.binary()),
        pa.ListArray.from_arrays(
            pa.array(rare_ends, pa.int32()),
            walk.lattices(words_left.filter(pa.array(~long))).take(pa.array(lattice[in_row % max(len(names), 1)]))),
    ], ["ids", "rare"])


def _finished(batch: pa.Array, found: pa.Array, marks: pa.Array, vocabulary: Vocabulary,
              spelling: pa.Array) -> pa.Array:
    """Whole ids of each row, with those of the words that were not shared in their places."""
    packed = zstandard.ZstdDecompressor()
    rows = [np.frombuffer(packed.decompress(ids), np.int32) for ids in batch.to_pylist()]
    sizes = np.array([len(own) for own in rows], np.int64)
    ids = np.concatenate([*rows, np.zeros(0, np.int32)])
    lists = found.flatten()
    first, size, others = _with_bytes(
        lists.flatten().to_numpy(), pc.list_value_length(lists).to_numpy().astype(np.int64), vocabulary)
    # The k-th of a row's words that were not shared is as many behind the first of the row.
    words = pc.list_value_length(found).fill_null(0).to_numpy().astype(np.int64)
    gaps = np.flatnonzero(ids < 0)
    number = np.repeat(np.cumsum(words) - words, sizes)[gaps] - ids[gaps] - 1
    begins, counts = np.arange(len(ids)), np.ones(len(ids), np.int64)
    begins[gaps], counts[gaps] = len(ids) + first[number], size[number]
    ends = np.concatenate(([0], np.cumsum(counts)))[np.concatenate(([0], np.cumsum(sizes)))]
    ids = np.concatenate((ids, others))[_ragged(begins, counts)]
    lowest, highest = min(vocabulary.byte_ids), max(vocabulary.byte_ids)
    bytes_before = np.concatenate(([0], np.cumsum((ids >= lowest) & (ids <= highest))))[ends]
    spelled = spelling.take(pa.array(ids))
    at = np.frombuffer(spelled.buffers()[1], np.int64)[spelled.offset + ends].tolist()
    text = memoryview(spelled.buffers()[2] or b"")
    same = [xxhash.xxh64_intdigest(_spaced(bytes(text[a:b])), 42) == mark % (1 << 64)
            for a, b, mark in zip(at, at[1:], marks.to_pylist())]
    return pa.StructArray.from_arrays([
        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids)),
        pa.array(np.diff(bytes_before), pa.int64()), pa.array(same, pa.bool_()),
    ], ["ids", "spelled", "same"])


def _in_parts(length: int) -> Iterator[int]:
    return range(0, max(length, 1), _ROWS_AT_ONCE)


def encode(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", doc_id: str = "doc_id",
           most_shared: int = 1 << 18) -> DataFrame:
    """``(doc_id, ids, n_spelled, round_trip)`` of every row: all ids of its text, in order.

    ``n_spelled`` counts ids that spell a byte. ``round_trip`` tells whether the ids,
    decoded, are the text again, byte for byte, by its 64-bit hash; it is so unless the text
    holds the mark for spaces itself.

    Up to ``most_shared`` frequent words, of fewer than 64 characters each, are encoded
    first and broadcast. A text's shared words are looked up where it is read, and its other
    words are folded beside them. Its ids, in compressed form, and those of the other words
    are then dealt out by row, the one large shuffle, and put together there.
    A text that is very long is one row with as many ids. Null and empty texts have no ids;
    repeated rows stay repeated. An empty table gives an empty result.

    The session's Arrow batches are set to 1,000 rows, if they are larger.
    """
    plain = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    texts = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), plain.alias("text"))
    context = docs.sparkSession.sparkContext
    # Rows here are whole texts, so the usual ten thousand make batches of some hundred MB.
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(docs.sparkSession.conf.get(size)) <= _ROWS_AT_ONCE:
        docs.sparkSession.conf.set(size, str(_ROWS_AT_ONCE))
    words_known = context.broadcast(_shared(texts, vocabulary, most_shared))
    pieces_known, walk_known = context.broadcast(vocabulary), context.broadcast(_Walk.of(vocabulary))

    @F.arrow_udf("struct<ids:binary,rare:array<array<array<struct<start:int,id:int,score:double>>>>>")
    def looked_up(lists: Iterator[pa.Array]) -> Iterator[pa.Array]:
        shared, own = words_known.value, pieces_known.value
        by_piece = {piece: (i, score) for i, piece, score in own.pieces}
        for many in lists:
            yield pa.concat_arrays([
                _looked_up(words_of(many.slice(at, _ROWS_AT_ONCE), own), shared, by_piece, own, walk_known.value)
                for at in _in_parts(len(many))])
            pa.default_memory_pool().release_unused()

    @F.arrow_udf("struct<ids:array<int>,spelled:bigint,same:boolean>")
    def finished(columns: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        own = pieces_known.value
        spelling = pa.array(own.texts, pa.large_binary())
        for many in columns:
            yield pa.concat_arrays([
                _finished(*(c.slice(at, _ROWS_AT_ONCE) for c in many), own, spelling)
                for at in _in_parts(len(many[0]))])
            pa.default_memory_pool().release_unused()

    numbered = texts.withColumn("_row", F.monotonically_increasing_id())
    looked = numbered.select("doc_id", "_row", F.xxhash64("text").alias("mark"),
                          looked_up(F.make_valid_utf8("text")).alias("own"))
    folded = looked.select("doc_id", "_row", "mark", F.col("own.ids").alias("ids"), F.transform(
        "own.rare", _best_ids_by_end).alias("found"))
    done = folded.repartition("_row").select(
        "doc_id", finished("ids", "found", "mark").alias("d"))
    return done.select("doc_id", F.col("d.ids").alias("ids"), F.col("d.spelled").alias("n_spelled"),
                       F.col("d.same").alias("round_trip"))


def summarize(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", doc_id: str = "doc_id",
              most_shared: int = 1 << 18) -> DataFrame:
    """``encode`` with the number of ids: ``(doc_id, n_pieces, n_spelled, ids, round_trip)``."""
    found = encode(docs, vocabulary, text, doc_id, most_shared)
    return found.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "n_spelled", "ids",
                        "round_trip")
