"""SentencePiece encoding and decoding with sampled segmentations.

A text's segmentations are the paths of a lattice of pieces; a piece weighs ``-theta`` times the
logarithm of its rank, and a character without a piece is its byte pieces. Segmentations are
drawn without replacement by Gumbel top-k: every one's log-probability gets Gumbel noise, and
the ``k`` largest are taken. They are found by a perturbed A-star search without making the
others: a prefix is known by the sum over all its completions, whose largest perturbed value has
a known distribution, so the search always follows the best prefix and draws the values of those
beside it below that bound (Maddison et al. 2014; Kool et al. 2019). The best completion keeps
its prefix's value, so a search goes straight down once per sample.

Pieces never cross from a word to the white space after it. The lattices of distinct words are
built and summed together, a batch's new ones at a time, and kept for later batches up to a bound;
the descents of all texts of a batch are array work too.
Random numbers are hashes of the row key and the place of their use, so a row's samples depend
on no other row and no partitioning. A sample comes with its log-probability, its perturbed
value, and the logarithm of its inclusion score 1 - exp(-exp(log_prob - kappa)), kappa being the
value of the best segmentation not taken: exp(log_prob - log_inclusion) is the weight for unbiased
estimates over samples.

Null or empty text: one empty segmentation, score 1. Texts with fewer than ``k`` segmentations
give all of them, score 1. Repeated rows give equal samples. A null id is a key like another.
Texts are read whole. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talentlake.llm.frames import map_slices, remembered, texts_of, typed
from talentlake.llm.shingles import mixed

SAMPLES = 2
THETA = 1.0
SEED = 41
BATCH = 2_000_000  # characters of texts at a time; a longer text is a batch of its own
WINDOW = 40.0  # how much less likely, as a logarithm, prefixes are that are looked at first
LIFT = 38.0  # more than -log(-log(u)) of any u below 1 that 53 bits hold
COMMON = 384  # code points that the trie's array covers
REMEMBERED_EDGES = 6_000_000  # of words of earlier batches; about 50 bytes each with their states

_SPACE = np.frombuffer("▁".encode(), dtype=np.uint8)
RUNGS = 2**36  # steps of a state's ladder
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


class Lattices:
    """Words' places and the pieces that start there, in order of word and place: ``places`` per
    word, ``edges`` per place, and per edge its end, weight and id (-1: ``spelled`` in bytes)."""

    def __init__(self, places: np.ndarray, edges: np.ndarray, end: np.ndarray, weight: np.ndarray, piece: np.ndarray, spelled: dict[int, bytes]):
        self.places, self.edges, self.end, self.weight, self.piece, self.spelled = places, edges, end, weight, piece, spelled

    def __add__(self, other: Lattices) -> Lattices:
        n = len(self.end)
        return Lattices(
            np.concatenate([self.places, other.places]),
            np.concatenate([self.edges, other.edges]),
            np.concatenate([self.end, other.end]),
            np.concatenate([self.weight, other.weight]),
            np.concatenate([self.piece, other.piece]),
            self.spelled | {n + e: raw for e, raw in other.spelled.items()},
        )


class Pieces:
    """A piece model's vocabulary as a dictionary and as a trie in an array."""

    def __init__(self, path: str, theta: float):
        import sentencepiece

        self.processor = p = sentencepiece.SentencePieceProcessor(model_file=path)
        usual = [i for i in range(p.get_piece_size()) if not (p.is_control(i) or p.is_unknown(i) or p.is_byte(i))]
        self.weights = np.zeros(p.get_piece_size())
        self.weights[usual] = [-theta * math.log(2 - p.get_score(i)) for i in usual]
        self.pieces = {p.id_to_piece(i): i for i in usual}
        self.longest = max(map(len, self.pieces))
        self.bytes = {b: np.uint32(p.piece_to_id(f"<0x{b:02X}>")).tobytes() for b in range(256)}
        self.byte_weight = -theta * math.log(2 + p.get_piece_size())
        for b in range(1, 128):  # a character that is one byte is spelled by one piece
            if chr(b) not in self.pieces:
                self.pieces[chr(b)] = i = p.piece_to_id(f"<0x{b:02X}>")
                self.weights[i] = self.byte_weight
        self._plant()
        self.lexicon = Lexicon()

    def _plant(self) -> None:
        """The trie of pieces in common characters; node 0 is the root, -1 no node."""
        children, pieces = [{}], [-1]
        for text, i in self.pieces.items():
            columns = [0 if c == "▁" else ord(c) for c in text]
            if max(columns) >= COMMON:
                continue
            node = 0
            for column in columns:
                if column not in children[node]:
                    children[node][column] = len(children)
                    children.append({})
                    pieces.append(-1)
                node = children[node][column]
            pieces[node] = i
        self.next = np.full((len(children), COMMON), -1, dtype=np.int32)
        for node, below in enumerate(children):
            self.next[node, list(below)] = list(below.values())
        self.piece_at = np.array(pieces, dtype=np.int32)
        spare = [c for c in range(COMMON) if self.next[0, c] < 0 or self.piece_at[self.next[0, c]] < 0]
        # Words of these characters only have a piece for every character of theirs.
        self.common = np.zeros(COMMON + 1, dtype=bool)
        self.common[1:COMMON] = True
        self.common[spare] = False

    def are_common(self, words: list[str]) -> np.ndarray:
        if not words:
            return np.zeros(0, dtype=bool)
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        known = self.common[np.minimum(codes, COMMON)] | (codes == ord("▁"))
        return np.logical_and.reduceat(known, np.cumsum(lengths) - lengths)

    def common_lattices(self, words: list[str]) -> Lattices:
        """All places of all words at once, a piece length at a time."""
        places = np.array([len(w) for w in words], dtype=np.int64)
        codes = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4").astype(np.int64)
        codes[codes == ord("▁")] = 0
        last = np.repeat(np.cumsum(places), places)
        at = np.arange(len(codes))
        node = np.zeros(len(codes), dtype=np.int64)
        rank = np.zeros(len(codes), dtype=np.int64)
        found = []
        for length in range(1, self.longest + 1):
            node = self.next[node, codes[at + length - 1]]
            alive = node >= 0
            at, node = at[alive], node[alive]
            if not len(at):
                break
            piece = self.piece_at[node]
            whole = piece >= 0
            starts = at[whole]
            found.append((starts, rank[starts], starts + length, piece[whole]))
            rank[starts] += 1
            longer = at + length < last[at]
            at, node = at[longer], node[longer]
        first = np.cumsum(rank) - rank
        total = int(rank.sum())
        end, piece = np.empty(total, dtype=np.int64), np.empty(total, dtype=np.int64)
        for starts, ranks, ends, pieces in found:
            slots = first[starts] + ranks
            end[slots], piece[slots] = ends, pieces
        base = np.repeat(np.repeat(np.cumsum(places) - places, places), rank)
        return Lattices(places, rank, end - base, self.weights[piece], piece, {})

    def other_lattices(self, words: list[str]) -> Lattices:
        """Words with other characters, one by one; what has no piece is spelled in bytes."""
        edges, end, weight, piece, spelled = [], [], [], [], {}
        for word in words:
            for place in range(len(word)):
                before = len(end)
                for stop in range(place + 1, min(len(word), place + self.longest) + 1):
                    i = self.pieces.get(word[place:stop], -1)
                    if i < 0 and stop == place + 1:
                        raw = word[place].encode("utf-8")
                        spelled[len(end)] = b"".join(self.bytes[b] for b in raw)
                        weight.append(self.byte_weight * len(raw))
                    elif i >= 0:
                        weight.append(self.weights[i])
                    else:
                        continue
                    end.append(stop)
                    piece.append(i)
                edges.append(len(end) - before)
        whole = [np.array(x, dtype=np.int64) for x in ([len(w) for w in words], edges, end, piece)]
        return Lattices(whole[0], whole[1], whole[2], np.array(weight, dtype=np.float64), whole[3], spelled)


def pieces(path: str, theta: float) -> Pieces:
    return remembered(Pieces, path, theta)


def _stirred(seed: np.ndarray, place: np.ndarray | int) -> np.ndarray:
    return mixed(seed + (np.atleast_1d(place).astype(np.uint64) + np.uint64(1)) * _GOLDEN)


def _uniform(seed: np.ndarray, *places: np.ndarray | int) -> np.ndarray:
    """Numbers strictly between 0 and 1 from a seed and the place of their use."""
    for place in places:
        seed = _stirred(seed, place)
    return ((seed >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def _shares(edges: np.ndarray, first_edge: np.ndarray, target: np.ndarray, weight: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Logarithm of each edge's share of all completions, summed from the words' ends."""
    left = last - np.arange(len(last))
    furthest = int(left.max(initial=0))
    order = np.argsort(left.astype(np.uint16) if furthest < 1 << 16 else left, kind="stable")
    cuts = np.searchsorted(left[order], np.arange(1, furthest + 2))
    # Edges in the order of their states, so that states equally far from an end are one run.
    count = edges[order]
    stops = np.cumsum(count)
    moved = _ranges(first_edge[order], count)
    target, weight = target[moved], weight[moved]
    after = np.zeros(len(last))
    share = np.empty(len(weight))
    for start, stop in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        counts = count[start:stop]
        low, high = int(stops[start] - count[start]), int(stops[stop - 1])
        heads = stops[start:stop] - counts - low
        value = weight[low:high] + after[target[low:high]]
        top = np.maximum.reduceat(value, heads)
        total = top + np.log(np.add.reduceat(np.exp(value - np.repeat(top, counts)), heads))
        after[order[start:stop]] = total
        share[moved[low:high]] = value - np.repeat(total, counts)
    return share


def split_words(texts: list[str]) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts, and how many each has. A word is white space and what follows up to
    the next white space; white space that ends a text is a word too."""
    raw = [text.encode() for text in texts]
    ends = np.cumsum([len(r) for r in raw], dtype=np.int64)
    data = b"".join(raw)
    codes = np.frombuffer(data, dtype=np.uint8)
    if not len(codes):
        return pa.array([], type=pa.large_string()), np.zeros(len(texts), dtype=np.int64)
    at = np.flatnonzero(codes[:-2] == _SPACE[0])
    at = at[(codes[at + 1] == _SPACE[1]) & (codes[at + 2] == _SPACE[2])]
    begins = np.zeros(len(codes), dtype=bool)
    begins[at[np.diff(at, prepend=-4) != 3]] = True
    begins[(ends - np.diff(ends, prepend=0))[np.diff(ends, prepend=0) > 0]] = True
    starts = np.flatnonzero(begins)
    offsets = np.append(starts, len(codes))
    words = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    return words, np.diff(np.searchsorted(starts, ends), prepend=0)


def _ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers ``first``, ``first`` + 1 and so on, ``count`` of them, of each range one after the other."""
    return np.repeat(first - np.cumsum(count) + count, count) + np.arange(int(count.sum()))


class Lexicon(dict):
    """Numbers of words, and one table of their states (word, place) and edges (pieces). Words
    stay for the texts that follow; beyond ``REMEMBERED_EDGES`` those go that only one batch had."""

    STATES = {"edges": np.int64, "first_edge": np.int64}  # of which a word's last state has none
    EDGES = {"source": np.int64, "rank": np.int32, "target": np.int64, "piece": np.int32, "share": np.float64, "ladder": np.int64}
    WORDS = {"state_of_word": np.int64, "states_of_word": np.int32, "edge_of_word": np.int64, "edges_of_word": np.int32, "met": np.int32}

    def __init__(self):
        super().__init__()
        self._start()

    def _start(self) -> None:
        self.clear()
        self.missed: list[str] = []
        self.spelled: dict[int, bytes] = {}
        # Room for as much as stays; what is not written takes no memory.
        self._room = {name: np.empty(REMEMBERED_EDGES, dtype=kind) for name, kind in (self.STATES | self.EDGES | self.WORDS).items()}
        for name, room in self._room.items():
            setattr(self, name, room[:0])

    def __missing__(self, word: str) -> int:
        self.missed.append(word)
        self[word] = number = len(self)
        return number

    def _append(self, name: str, values: np.ndarray) -> None:
        """Room grows by halves, so that a table is seldom copied."""
        used, room = len(getattr(self, name)), self._room[name]
        if used + len(values) > len(room):
            self._room[name] = np.empty(used + len(values) + used // 2, dtype=room.dtype)
            self._room[name][:used] = room[:used]
            room = self._room[name]
        room[used : used + len(values)] = values
        setattr(self, name, room[: used + len(values)])

    def numbers(self, model: Pieces, occurrences: pa.Array) -> np.ndarray:
        """Each word's number; words not met before enter the table."""
        coded = occurrences.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        found = np.fromiter(map(self.__getitem__, distinct), dtype=np.int64, count=len(distinct))
        if self.missed:
            self._learn(model, self.missed)
            self.missed = []
        self.met[found] += 1
        return found[coded.indices.to_numpy()]

    def _learn(self, model: Pieces, words: list[str]) -> None:
        known = model.are_common(words)
        order = np.argsort(~known, kind="stable")
        common = [w for w, is_common in zip(words, known.tolist()) if is_common]
        other = [w for w, is_common in zip(words, known.tolist()) if not is_common]
        lattices = model.common_lattices(common) + model.other_lattices(other)
        sizes = lattices.places + 1  # the last state of a word has no edge
        state_of_word = np.concatenate([[0], np.cumsum(sizes)])
        total = int(state_of_word[-1])
        final = np.zeros(total, dtype=bool)
        final[state_of_word[1:] - 1] = True
        edges = np.zeros(total, dtype=np.int64)
        edges[~final] = lattices.edges
        first_edge = np.cumsum(edges) - edges
        source = np.repeat(np.arange(total), edges)
        rank = np.arange(len(source)) - first_edge[source]
        target = lattices.end + np.repeat(state_of_word[:-1], sizes)[source]
        share = _shares(edges, first_edge, target, lattices.weight, np.repeat(state_of_word[1:] - 1, sizes))
        # Ascending over all edges: a state's number, then the cumulated shares inside it. Whole
        # numbers, so that a row's draws do not depend on what else is in the table.
        running = np.cumsum(np.rint(np.exp(share) * RUNGS).astype(np.int64))
        before = np.concatenate([[0], running])[first_edge[source]]
        states, length = len(self.edges), len(self.source)
        self.spelled |= {length + e: raw for e, raw in lattices.spelled.items()}
        edge_of_word = np.concatenate([first_edge, [len(source)]])[state_of_word]
        place = np.argsort(order, kind="stable")  # words are numbered as they came
        for name, values in (
            ("edges", edges),
            ("first_edge", first_edge + length),
            ("rank", rank),
            ("piece", lattices.piece),
            ("share", share),
            ("ladder", (source + states) * RUNGS + np.minimum(running - before, RUNGS)),
            ("source", source + states),
            ("target", target + states),
            ("state_of_word", (state_of_word[:-1] + states)[place]),
            ("states_of_word", sizes[place]),
            ("edge_of_word", (edge_of_word[:-1] + length)[place]),
            ("edges_of_word", np.diff(edge_of_word)[place]),
            ("met", np.zeros(len(words), dtype=np.int32)),
        ):
            self._append(name, values)

    def forget(self) -> None:
        """Keeps a table that is too large to words that were met again, if these are few enough."""
        if len(self.source) <= REMEMBERED_EDGES:
            return
        words = np.flatnonzero(self.met > 1)
        if 2 * int(self.edges_of_word[words].sum()) > REMEMBERED_EDGES:
            self._start()
            return
        names, spelled = list(self), self.spelled
        old = {name: getattr(self, name) for name in self._room}
        self._start()
        self.update((names[w], i) for i, w in enumerate(words.tolist()))
        n_states, n_edges = old["states_of_word"][words].astype(np.int64), old["edges_of_word"][words].astype(np.int64)
        states, edges = _ranges(old["state_of_word"][words], n_states), _ranges(old["edge_of_word"][words], n_edges)
        state_of_word, edge_of_word = np.cumsum(n_states) - n_states, np.cumsum(n_edges) - n_edges
        shift = state_of_word - old["state_of_word"][words]
        on_states = np.repeat(edge_of_word - old["edge_of_word"][words], n_states)
        on_edges = np.repeat(shift, n_edges)
        moved = {"source": on_edges, "target": on_edges, "ladder": on_edges * RUNGS, "first_edge": on_states}
        for name in self.STATES | self.EDGES:
            values = old[name][states if name in self.STATES else edges]
            self._append(name, values + moved[name] if name in moved else values)
        for name, values in (
            ("state_of_word", state_of_word),
            ("states_of_word", n_states),
            ("edge_of_word", edge_of_word),
            ("edges_of_word", n_edges),
            ("met", np.ones(len(words), dtype=np.int32)),
        ):
            self._append(name, values)
        at = np.flatnonzero(self.piece < 0)
        self.spelled = {e: spelled[o] for e, o in zip(at.tolist(), edges[at].tolist())}


class Batch:
    """The texts of a batch over the table of the words met so far."""

    def __init__(self, model: Pieces, texts: list[str]):
        words, counts = split_words([model.processor.normalize(text) if text else "" for text in texts])
        self.last = np.cumsum(counts)
        self.first = self.last - counts
        lexicon = model.lexicon
        self.word = lexicon.numbers(model, words)
        self.state_of_word = lexicon.state_of_word
        self.edges, self.first_edge = lexicon.edges, lexicon.first_edge
        self.source, self.rank, self.target = lexicon.source, lexicon.rank, lexicon.target
        self.piece, self.spelled = lexicon.piece, lexicon.spelled
        self.share, self.ladder = lexicon.share, lexicon.ladder

    def ids(self, edges: np.ndarray) -> bytes:
        piece = self.piece[edges]
        if (piece >= 0).all():
            return piece.astype("<u4").tobytes()
        raw, out, start = piece.astype("<u4").tobytes(), [], 0
        for at in np.flatnonzero(piece < 0).tolist():
            out += [raw[start : 4 * at], self.spelled[int(edges[at])]]
            start = 4 * at + 4
        return b"".join([*out, raw[start:]])

    def descend(self, word: np.ndarray, state: np.ndarray, seed: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Draws a path through each word occurrence from its state on; returns (occurrence,
        edge) in order of occurrence and place."""
        found = []
        # Equal words side by side: neighbours then read the same part of the table.
        at = np.argsort(state, kind="stable")
        state = state[at]
        count = np.zeros(len(word), dtype=np.int64)
        step = 0
        seed = _stirred(seed, place)
        while True:
            choices = self.edges[state]
            going = np.flatnonzero(choices)
            if len(going) < len(at):
                at, state, choices = at[going], state[going], choices[going]
            if not len(at):
                break
            edge = self.first_edge[state]
            several = np.flatnonzero(choices > 1)
            u = _uniform(seed[at[several]], step)
            drawn = state[several] * RUNGS + (u * RUNGS).astype(np.int64)
            low = edge[several]
            last = low + choices[several] - 1
            # A state has few edges, most of them soon passed or taken.
            while len(several):
                higher = np.flatnonzero(self.ladder[low] <= drawn)
                several, drawn, low, last = several[higher], drawn[higher], low[higher] + 1, last[higher]
                edge[several] = low
                more = np.flatnonzero(low < last)
                several, drawn, low, last = several[more], drawn[more], low[more], last[more]
            found.append((at, edge))
            state = self.target[edge]
            step += 1
            count[at] = step
        heads = np.cumsum(count) - count
        edges = np.empty(int(count.sum()), dtype=np.int64)
        for step, (at, edge) in enumerate(found):
            edges[heads[at] + step] = edge
        return np.repeat(word, count), edges


class Search:
    """Samples of one text so far and the prefixes beside them, best ones first."""

    def __init__(self, keep: int):
        self.keep = keep
        self.open: list[tuple[float, int, int, int]] = []  # value, sample, step, edge
        self.paths: list[tuple[np.ndarray, np.ndarray, float, float]] = []  # words, edges, log_prob, value


def sample(model: Pieces, texts: list[str], keys: list[int], k: int) -> list[list[tuple[bytes, float, float, float]]]:
    """Per text its samples, best first: (ids, log_prob, perturbed value, log of the inclusion score)."""
    batch = Batch(model, texts)
    seeds = mixed(np.array(keys, dtype=np.uint64))
    searches = [Search(k + 1) for _ in texts]
    roots = -np.log(-np.log(_uniform(seeds, 0))) if len(texts) else np.zeros(0)
    for turn in range(k):
        # Each text's best prefix: its text, value, steps kept of an earlier path, and where it goes on.
        todo = []
        for i, search in enumerate(searches):
            if turn == 0:
                todo.append((i, float(roots[i]), None, None, batch.first[i], None))
            elif search.open:
                value, parent, step, edge = search.open.pop(0)
                words, edges = search.paths[parent][:2]
                todo.append((i, value, words[:step], edges[:step], words[step], edge))
        if not todo:
            break
        spans = [np.arange(start, batch.last[i]) for i, _, _, _, start, _ in todo]
        lengths = np.array([len(s) for s in spans])
        word = np.concatenate(spans)
        state = batch.state_of_word[batch.word[word]]
        heads = np.cumsum(lengths) - lengths
        for head, (_, _, _, _, _, edge) in zip(heads.tolist(), todo):
            if edge is not None:
                state[head] = batch.target[edge]
        owner = np.repeat([t[0] for t in todo], lengths)
        place = (word - batch.first[owner]) * k + turn
        words, edges = batch.descend(word, state, seeds[owner], place)
        cuts = np.searchsorted(words, [batch.last[t[0]] for t in todo])
        at = 0
        grown = []
        for (i, value, old_words, old_edges, start, edge), cut in zip(todo, cuts.tolist()):
            new_words, new_edges = words[at:cut], edges[at:cut]
            at = cut
            kept = 0
            if edge is not None:
                new_words = np.concatenate([old_words, [start], new_words])
                new_edges = np.concatenate([old_edges, [edge], new_edges])
                kept = len(old_edges) + 1
            gone = np.concatenate([[0.0], np.cumsum(batch.share[new_edges])])
            searches[i].paths.append((new_words, new_edges, float(gone[-1]), value))
            grown.append(Path(searches[i], new_edges, gone, kept, value))
        _beside(batch, grown, _stirred(seeds[[t[0] for t in todo]], 1 + turn))
    found = [_samples(batch, search) for search in searches]
    model.lexicon.forget()
    return found


class Path:
    """A path just found, and up to where the prefixes that leave it are looked at."""

    def __init__(self, search: Search, edges: np.ndarray, gone: np.ndarray, kept: int, value: float):
        self.search, self.edges, self.gone, self.kept, self.value = search, edges, gone, kept, value
        self.look(gone[kept] - WINDOW)

    def look(self, reach: float) -> None:
        # What leaves the path late is far less likely than what leaves it early.
        self.reach = reach
        gone = self.gone[self.kept : len(self.edges)]
        self.stop = self.kept + int(np.searchsorted(-gone, -reach, side="right"))

    def settled(self, drawn: list[float]) -> bool:
        """Whether none that leaves the path later can be among the best; ``drawn`` are the best
        values so far, in descending order. Else the path is to be looked at further."""
        if self.stop == len(self.edges):
            return True
        if len(drawn) < self.search.keep:
            self.look(self.reach - WINDOW)
            return False
        # No draw lifts a prefix by more than LIFT, so later ones stay below those found.
        if self.gone[self.stop] + LIFT < drawn[-1]:
            return True
        self.look(drawn[-1] - LIFT)
        return False


def _beside(batch: Batch, paths: list[Path], stirred: np.ndarray) -> None:
    """Records the best prefixes that leave paths after the steps they kept."""
    while paths:
        lengths = np.array([p.stop - p.kept for p in paths])
        owner = np.repeat(np.arange(len(paths)), lengths)
        step = _ranges(np.array([p.kept for p in paths]), lengths)
        drawn, at, edge = _leaving(
            batch,
            np.concatenate([p.edges[p.kept : p.stop] for p in paths]),
            np.concatenate([p.gone[p.kept : p.stop] for p in paths]),
            np.array([p.value for p in paths])[owner],
            _stirred(stirred[owner], step),
        )
        cuts = np.searchsorted(owner[at], np.arange(len(paths) + 1)).tolist()
        minus = -drawn
        unsettled = []
        for i, path in enumerate(paths):
            search = path.search
            own_draws = minus[cuts[i] : cuts[i + 1]]
            best = np.arange(len(own_draws))
            if len(best) > search.keep:
                best = np.argpartition(own_draws, search.keep - 1)[: search.keep]
            best = cuts[i] + best[np.argsort(own_draws[best], kind="stable")]
            values = drawn[best].tolist()
            if not path.settled(values):
                unsettled.append(i)
                continue
            own = len(search.paths) - 1
            found = zip(values, [own] * len(best), step[at[best]].tolist(), edge[best].tolist())
            search.open = sorted([*search.open, *found], key=lambda x: (-x[0], x[1:]))[: search.keep]
        paths, stirred = [paths[i] for i in unsettled], stirred[unsettled]


def _leaving(
    batch: Batch, edges: np.ndarray, gone: np.ndarray, value: np.ndarray, stirred: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(perturbed value, place among the steps, edge) of the prefixes that leave paths at steps
    of theirs, given by edge, log-probability before it, path's value and seed."""
    source = batch.source[edges]
    count = batch.edges[source]
    at = np.repeat(np.arange(len(edges)), count)
    edge = _ranges(batch.first_edge[source], count)
    other = np.flatnonzero(edge != edges[at])
    at, edge = at[other], edge[other]
    mass = gone[at] + batch.share[edge]
    u = _uniform(stirred[at], batch.rank[edge])
    return mass - np.log(np.exp(np.minimum(mass - value[at], 700.0)) - np.log(u)), at, edge


def _samples(batch: Batch, search: Search) -> list[tuple[bytes, float, float, float]]:
    kappa = search.open[0][0] if search.open else -math.inf
    out = []
    for _, edges, log_prob, value in search.paths:
        x = log_prob - kappa  # of long texts far below 0, where log(1 - exp(-exp(x))) is x
        score = x if x < -30 else 0.0 if x > 6 else math.log(-math.expm1(-math.exp(x)))
        out.append((batch.ids(edges), log_prob, value, score))
    return out


def _spans(lengths: list[int]) -> Iterator[tuple[int, int]]:
    """Runs of neighbouring texts of up to ``BATCH`` characters together."""
    start = total = 0
    for i, length in enumerate(lengths):
        if i > start and total + length > BATCH:
            yield start, i
            start, total = i, 0
        total += length
    if lengths:
        yield start, len(lengths)


def encode(
    docs: DataFrame,
    model_path: str,
    k: int = SAMPLES,
    theta: float = THETA,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per sample: ``doc_id``, ``sample`` (0 the best), ``ids`` (little-endian unsigned
    32-bit numbers), ``log_prob``, ``perturbed``, ``log_inclusion``."""

    def run(batch: pa.RecordBatch) -> dict[str, object]:
        owner, rows = [], []
        ids = batch.column("doc_id").to_pylist()
        model = pieces(model_path, theta)
        for start, stop in _spans(pa.compute.utf8_length(batch.column("text")).fill_null(0).to_pylist()):
            keys = [xxhash.xxh64_intdigest(repr(i).encode(), seed=SEED) for i in ids[start:stop]]
            for i, found in enumerate(sample(model, texts_of(batch.slice(start, stop - start)), keys, k), start):
                owner += [i] * len(found)
                rows += [(rank, *s) for rank, s in enumerate(found)]
        columns = list(zip(*rows)) or [()] * 5
        return {
            "doc_id": batch.column("doc_id").take(pa.array(owner, type=pa.int64())),
            "sample": pa.array(columns[0], type=pa.int32()),
            "ids": pa.array(columns[1], type=pa.binary()),
            "log_prob": pa.array(columns[2], type=pa.float64()),
            "perturbed": pa.array(columns[3], type=pa.float64()),
            "log_inclusion": pa.array(columns[4], type=pa.float64()),
        }

    read = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = f"doc_id {typed(read, 'doc_id')}, sample int, ids binary, log_prob double, perturbed double, log_inclusion double"
    return map_slices(read, run, schema)


def decode(ids: Column, model_path: str) -> Column:
    """The text of a column of ids as ``encode`` gives them; null for null."""

    def run(column: pa.Array) -> pa.Array:
        processor = pieces(model_path, THETA).processor
        return pa.array(
            [None if x is None else processor.decode(np.frombuffer(x, "<u4").tolist()) for x in column.to_pylist()],
            type=pa.string(),
        )

    return F.arrow_udf(run, "string")(ids)
