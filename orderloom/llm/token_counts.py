"""Token counts by a piece vocabulary, compiled into a deterministic transducer.

Byte-pair merging joins, again and again, the neighbours whose piece has the best score. Which pieces come out can be told
from left to right: a sequence of pieces is the result for its text if each two neighbours, merged by
themselves, come out as these two. So each prefix of a text has one last piece, and the state after a prefix is
the set of its suffixes that begin a piece, each with the last piece before it and the number of pieces up to
there, counted from the present number. A transition takes a character: suffixes that go on stay, the one that has become
a piece which may follow the piece before it is the new last piece, and the transition is annotated with the
change of the number of pieces. States and transitions are compiled when a text first needs them; where two
characters never meet in a piece, the state depends on the second one alone.

A long text is cut into chunks that are dealt out. A chunk has a state map: entry state -> exit state and
number of tokens, for all states that the characters before it, read from any place a short way back, lead to.
Runs from several entry states go on together until they meet. The maps of a text compose by a scan in rounds over
neighbours. A map that lacks the state needed leaves its text without a number; such a text is read as a whole.

Characters without a piece become a token for each of their bytes. Spaces count as the sign for a space, one of which
goes before each text. Models that change texts in other ways are refused.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from hashlib import sha256

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import picked, ship

SPACE = "▁"
LIMIT = 4096
# Characters of a chunk; longer texts are cut.
CHUNK = 1 << 16
# Characters before a chunk that are read for its entry states, and the places from which they are read.
REACH, PLACES = 96, 48
# A beginning of so few pieces is tested against all of them.
FEW = 8
# Compiled states, and leaps over a word, kept by a task at a time; longer words are read by characters.
STATES, LEAPS, LEAP = 1 << 17, 1 << 18, 48


@dataclass(slots=True)
class Node:
    """A beginning of pieces; `weight` is the number of tokens if it is a piece itself, else 0. `beyond` has the longer
    pieces that begin so."""

    prefix: str
    weight: int = 0
    children: dict[str, Node] = field(default_factory=dict)
    beyond: list[str] = field(default_factory=list)


_BEGINS = re.compile(f"(?<!{SPACE}){SPACE}")
_WORD = re.compile(f"{SPACE}+[^{SPACE}]*")


class State(dict):
    """Transitions by character: next state, change of the number of tokens. Compiled when first asked for."""

    __slots__ = ("machine", "live")

    def __missing__(self, ch: str) -> tuple[State, int]:
        return self.machine.compile(self, ch)

    def key(self) -> tuple:
        return tuple((node.prefix, before, number) for node, before, number in self.live)


class Leaps(dict):
    """Transitions by whole words, from where a word begins: tokens up to its end. The state there doesn't matter, as the
    space that follows leads to the same state from all."""

    __slots__ = ("machine",)

    def __missing__(self, word: str) -> int:
        number = self.machine.read(self.machine.fresh(), word)[1]
        if len(word) <= LEAP:
            if len(self) >= LEAPS:
                self.clear()
            self[word] = number
        return number


class Machine:
    """The transducer of a vocabulary: pieces and their scores."""

    def __init__(self, pieces: dict[str, float], most_states: int = STATES):
        self.scores = pieces
        self.meet = {p[i : i + 2] for p in pieces for i in range(len(p) - 1)}
        self.edges = lru_cache(maxsize=None)(self._edges)  # of pieces, as many as there are
        self.root = Node("")
        for char in sorted({c for p in pieces for c in p}):
            self._plant(char, 1 if char in pieces else len(char.encode()))
        for piece in pieces:
            if len(piece) > 1 and self.merged(piece) == [piece]:
                self._plant(piece, 1)
        # Whether a space begins anew whatever stands before it, but another space.
        self.words = SPACE in self.root.children and all(a == SPACE or b != SPACE for a, b in self.meet)
        self.leaps = Leaps()
        self.leaps.machine = self
        self.most_states = most_states
        self.states: dict[tuple, State] = {}
        self.follows = lru_cache(maxsize=1 << 20)(self._follows)

    def _plant(self, piece: str, weight: int) -> None:
        node = self.root
        for i, char in enumerate(piece):
            node.beyond.append(piece)
            node = node.children.setdefault(char, Node(piece[: i + 1]))
        node.weight = weight

    def merged(self, text: str) -> list[str]:
        """The merging itself, on a short text: the best score first, of equal ones the leftmost."""
        parts = list(text)
        while (at := self._best(parts)) is not None:
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _best(self, parts: list[str]) -> int | None:
        best, at = None, None
        for i in range(len(parts) - 1):
            score = self.scores.get(parts[i] + parts[i + 1])
            if score is not None and (best is None or score > best):
                best, at = score, i
        return at

    def _edges(self, piece: str) -> tuple[tuple[str, ...], tuple[str, ...]]:
        """What stands at the left and at the right edge while the piece is merged."""
        left, right, parts = {}, {}, list(piece)
        while True:
            left[parts[0]] = right[parts[-1]] = None
            if len(parts) == 1:
                return tuple(left), tuple(right)
            at = self._best(parts)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _follows(self, before: str, piece: str) -> bool:
        if before + piece in self.scores:
            return False
        rights, lefts = self.edges(before)[1], self.edges(piece)[0]
        if not any(x + y in self.scores for x in rights for y in lefts):
            return True
        return self.merged(before + piece) == [before, piece]

    def state(self, live: tuple) -> State:
        key = tuple((node.prefix, before, number) for node, before, number in live)
        found = self.states.get(key)
        if found is None:
            found = State()
            found.machine, found.live = self, live
            self.states[key] = found
        return found

    def restored(self, key: Iterable[tuple[str, str | None, int]]) -> State:
        live = []
        for prefix, before, number in key:
            node = self.root
            for char in prefix:
                node = node.children[char]
            live.append((node, before, number))
        return self.state(tuple(live))

    def fresh(self) -> State:
        """Where a text begins."""
        return self.state(((self.root, None, 0),))

    def start(self) -> tuple[State, int]:
        """After the sign for a space that goes before each text."""
        return self.fresh()[SPACE]

    def compile(self, state: State, ch: str) -> tuple[State, int]:
        if len(self.states) > self.most_states:  # compiled anew where needed again
            for old in self.states.values():
                old.clear()
            self.states = {}
        if ch not in self.root.children:  # it is in no piece
            step = self.fresh(), len(ch.encode())
            state[ch] = step
            return step
        stay, last, change = [], None, 0
        for node, before, number in state.live:
            child = node.children.get(ch)
            if child is None:
                continue
            if node is self.root and before is not None and before[-1] + ch not in self.meet:
                before = None  # whatever stands before cannot merge with it
            if child.weight and (before is None or self.follows(before, child.prefix)):
                last, change = child.prefix, number + child.weight
            if before is not None and len(child.beyond) <= FEW:
                # What may still come decides what has to be remembered of the piece before.
                may = sum(1 << i for i, piece in enumerate(child.beyond) if self.follows(before, piece))
                if not may:
                    continue
                before = None if may == (1 << len(child.beyond)) - 1 else before
            if child.children:
                stay.append((child, before, number))
        live = tuple((node, before, number - change) for node, before, number in stay)
        step = self.state((*live, (self.root, last, 0))), change
        state[ch] = step
        return step

    def read(self, state: State, text: str) -> tuple[State, int]:
        """End state and change of the number of tokens, by characters."""
        total = 0
        for ch in text:
            state, change = state[ch]
            total += change
        return state, total

    def run(self, state: State, text: str) -> tuple[State, int]:
        """The same with leaps over the words between the first and the last that begin in the text."""
        first = _BEGINS.search(text, 1) if self.words else None
        if first is None:
            return self.read(state, text)
        middle, last = first.start(), text.rindex(SPACE)
        while text[last - 1] == SPACE:
            last -= 1
        total = self.read(state, text[:middle])[1] + sum(map(self.leaps.__getitem__, _WORD.findall(text, middle, last)))
        end, more = self.read(self.fresh(), text[last:])
        return end, total + more

    def count(self, text: str) -> int:
        if not text:
            return 0
        state, first = self.start()
        return first + self.run(state, text.replace(" ", SPACE))[1]


# --- chunks and their state maps

StateMap = dict[tuple, tuple[tuple, int]]


def entry_states(machine: Machine, before: str) -> list[State]:
    """The states that the characters before a chunk lead to, read from any of the places farthest back."""
    places = max(1, min(PLACES, len(before)))
    found = {}
    for place in range(places):
        state = machine.run(machine.fresh(), before[place:])[0]
        found[state.key()] = state
    return list(found.values())


def state_map(machine: Machine, entries: list[State], text: str) -> StateMap:
    """Exit state and tokens for each entry state. Runs that have come to the same state go on as one."""
    # By present state: the entries that have come there, with their numbers of tokens so far.
    runs: dict[int, tuple[State, list[tuple[tuple, int]]]] = {}
    for entry in entries:
        runs.setdefault(id(entry), (entry, []))[1].append((entry.key(), 0))
    at = 0
    while len(runs) > 1 and at < len(text):
        on: dict[int, tuple[State, list[tuple[tuple, int]]]] = {}
        for state, members in runs.values():
            after, change = state[text[at]]
            on.setdefault(id(after), (after, []))[1].extend((key, n + change) for key, n in members)
        runs, at = on, at + 1
    out = {}
    for state, members in runs.values():
        end, more = machine.run(state, text[at:])
        out |= {key: (end.key(), n + more) for key, n in members}
    return out


def composed(first: StateMap, second: StateMap) -> StateMap:
    """The map of two neighbours; entries whose exit the second doesn't know are left out."""
    return {
        entry: (second[middle][0], n + second[middle][1]) for entry, (middle, n) in first.items() if middle in second
    }


def scanned(maps: list[StateMap]) -> StateMap:
    """The map of all neighbours together, in rounds that halve them."""
    while len(maps) > 1:
        pairs = [composed(a, b) for a, b in zip(maps[::2], maps[1::2], strict=False)]
        maps = pairs + maps[len(pairs) * 2 :]
    return maps[0]


def _dumped(states: StateMap) -> str:
    return json.dumps([[entry, end, n] for entry, (end, n) in states.items()], ensure_ascii=False)


def _loaded(text: str) -> StateMap:
    def key(items: list) -> tuple:
        return tuple(map(tuple, items))

    return {key(entry): (key(end), n) for entry, end, n in json.loads(text)}


# --- the vocabulary, and the machine of a task


def vocabulary(model_path: str) -> dict[str, float]:
    """Pieces and scores of a model; its size is the model's."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=model_path)
    ids = range(model.vocab_size())
    if sum(map(model.is_byte, ids)) != 256:
        raise ValueError("the model has no pieces for bytes")
    probe = "  Ａé é  ﬁ "
    if model.encode(probe, out_type=str) and model.decode(model.encode(probe)) != probe:
        raise ValueError("the model changes texts before it merges")
    if "".join(model.encode(" a", out_type=str)) != f"{SPACE}{SPACE}a":
        raise ValueError("the model puts no space before a text, or removes some")
    special = (model.is_byte, model.is_control, model.is_unknown, model.is_unused)
    return {model.id_to_piece(i): model.get_score(i) for i in ids if not any(test(i) for test in special)}


@dataclass(frozen=True)
class Shared:
    """A vocabulary as the executors get it, named by its content."""

    name: str
    pieces: Broadcast


_MACHINES: dict[str, Machine] = {}


def _machine(shared: Shared) -> Machine:
    """One for all tasks of a worker process."""
    if shared.name not in _MACHINES:
        _MACHINES.clear()
        _MACHINES[shared.name] = Machine(shared.pieces.value)
    return _MACHINES[shared.name]


def _counted(shared: Shared):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _machine(shared)
        for batch in batches:
            numbers = [machine.count(text.as_py()) for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column("n_bytes"), pa.array(numbers, pa.int64())],
                names=[batch.schema.names[0], "n_bytes", "n_tokens"],
            )

    return count


def _cut(chunk: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """node, k, piece: the chunks, each with some characters before it."""
        for batch in batches:
            for node, scalar in zip(batch.column("node"), batch.column("text"), strict=True):
                text = scalar.as_py()
                for k, start in enumerate(range(0, len(text), chunk)):
                    piece = text[max(start - REACH, 0) : start + chunk]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([node.as_py()]), pa.array([k], pa.int32()), pa.array([piece])],
                        names=["node", "k", "piece"],
                    )

    return cut


def _mapped(shared: Shared):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """node, k, states: the chunks' state maps."""
        machine = _machine(shared)
        for batch in batches:
            maps = []
            for k, piece in zip(batch.column("k"), batch.column("piece"), strict=True):
                text = piece.as_py().replace(" ", SPACE)
                if k.as_py() == 0:
                    entries = [machine.start()[0]]
                else:
                    entries, text = entry_states(machine, text[:REACH]), text[REACH:]
                maps.append(_dumped(state_map(machine, entries, text)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("k"), pa.array(maps, pa.string())], names=["node", "k", "states"]
            )

    return read


def _scanned(shared: Shared):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """node, n_tokens: by the maps of all chunks; null where they do not compose."""
        machine = _machine(shared)
        first, number = machine.start()
        for batch in batches:
            totals = []
            for chunks in batch.column("chunks"):
                whole = scanned([_loaded(c["states"]) for c in chunks.as_py()])
                found = whole.get(first.key())
                totals.append(None if found is None else number + found[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array(totals, pa.int64())], names=["node", "n_tokens"]
            )

    return scan


def _node(text: Column) -> Column:
    return F.sha2(text, 256)


def long_counts(texts: DataFrame, shared: Shared, chunk: int) -> DataFrame:
    """node, n_tokens of the distinct texts, by chunks; null where the chunks' maps do not compose. A chunk found in many
    copies is reduced within each task before it is dealt out; a text has at most as many chunks as fit in a row."""
    pieces = texts.mapInArrow(_cut(chunk), "node string, k int, piece string")
    once = pieces.groupBy("node", "k").agg(F.first("piece").alias("piece"))
    maps = once.mapInArrow(_mapped(shared), "node string, k int, states string")
    chunks = maps.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("k", "states"))).alias("chunks"))
    return chunks.mapInArrow(_scanned(shared), "node string, n_tokens long")


def token_counts(
    docs: DataFrame,
    model_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = LIMIT,
    chunk: int = CHUNK,
) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit.

    `n_tokens` is the number of tokens of the whole text without added ones; the names of special tokens are
    ordinary text. A null text counts as empty, which has no token and no byte. Rows with a null or repeated id are rows
    like others. Further columns are left alone. An empty table gives an empty result. The vocabulary is read by the
    driver and sent to the executors: it has the size of the model file.
    """
    spark = docs.sparkSession
    ship(spark)
    pieces = vocabulary(model_path)
    name = sha256(repr(sorted(pieces.items())).encode()).hexdigest()
    shared = Shared(name, spark.sparkContext.broadcast(pieces))
    text = F.coalesce("text", F.lit(""))
    plain = picked(docs, doc_id=id_col, text=text_col)
    plain = plain.select("doc_id", F.octet_length(text).cast("bigint").alias("n_bytes"), text.alias("text"))
    is_long = F.length("text") > chunk
    schema = plain.select("doc_id", "n_bytes").schema.add("n_tokens", "long")
    short = plain.where(~is_long).mapInArrow(_counted(shared), schema)

    texts = plain.where(is_long).select("doc_id", "n_bytes", _node(F.col("text")).alias("node"), "text")
    totals = long_counts(texts.select("node", "text"), shared, chunk)
    rows = texts.select("doc_id", "n_bytes", "node", "text").join(totals.hint("merge"), "node", "left")
    known = rows.where("n_tokens is not null").select("doc_id", "n_bytes", "n_tokens")
    whole = rows.where("n_tokens is null").select("doc_id", "n_bytes", "text").mapInArrow(_counted(shared), schema)
    counted = short.unionAll(known).unionAll(whole)
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
