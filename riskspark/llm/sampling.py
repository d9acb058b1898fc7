"""SentencePiece encoding by sampling without replacement, and decoding.

A text's segmentations are the paths through its lattice of pieces. With theta times the piece
scores as weights they have probabilities that sum to 1, and adding independent Gumbel noise to
all log probabilities and taking the k largest gives k distinct paths, sampled without
replacement. The noise is never drawn for all paths: the largest noisy value below a node of the
tree of partial paths is itself Gumbel with the node's log probability as its place, and given
the parent's value the children's are independent but for their maximum. So the search keeps a
frontier of untaken branches with their exact noisy maxima, always goes down the best one, and
each time it reaches an end the next best path is found.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import mix, text_slices
from riskspark.llm.pieces import MARK, Vocabulary, marked_words

# Bytes of text that one search works on; its lattices take up to two hundred times as much.
SLICE = 200_000


class PieceTable:
    """The pieces as a trie whose steps can be taken by many places of a text at once."""

    BITS = 20

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.scores = np.array([*vocabulary.scores, vocabulary.unknown_score])
        steps: dict[tuple[int, int], int] = {}
        ends = {0: -1}
        for number, piece in enumerate(vocabulary.pieces):
            node = 0
            for char in piece:
                node = steps.setdefault((node, ord(char)), len(steps) + 1)
            ends[node] = number
        self.piece = np.array([ends.get(i, -1) for i in range(len(steps) + 1)], np.int64)
        keys = np.array([n << 21 | c for n, c in steps], np.int64)
        bucket = self._bucket(keys)
        order = np.argsort(bucket, kind="stable")
        # A key that no step has, so that a look past the last bucket finds nothing.
        self.keys = np.append(keys[order], -1)
        self.child = np.append(np.array(list(steps.values()), np.int64)[order], 0)
        self.begin = np.searchsorted(bucket[order], np.arange((1 << self.BITS) + 1)).astype(np.int32)

    def _bucket(self, keys: np.ndarray) -> np.ndarray:
        spread = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (spread >> np.uint64(64 - self.BITS)).astype(np.int64)

    def step(self, nodes: np.ndarray, chars: np.ndarray) -> np.ndarray:
        """The node that each character leads to, or 0."""
        keys = nodes << 21 | chars
        bucket = self._bucket(keys)
        at, end = self.begin[bucket].astype(np.int64), self.begin[bucket + 1]
        out = np.where((at < end) & (self.keys[at] == keys), self.child[at], 0)
        more = np.flatnonzero((out == 0) & (at + 1 < end))
        while len(more):
            at[more] += 1
            hit = self.keys[at[more]] == keys[more]
            out[more[hit]] = self.child[at[more[hit]]]
            more = more[~hit]
            more = more[at[more] + 1 < end[more]]
        return out


@dataclass
class Lattices:
    """Lattices of many words: nodes are places between characters, edges are pieces."""

    first: np.ndarray  # node of each word's start
    last: np.ndarray  # node of each word's end
    begin: np.ndarray  # first edge of each node; begin[node + 1] ends them
    start: np.ndarray  # node that an edge leaves
    to: np.ndarray  # node that it reaches
    piece: np.ndarray  # piece number, or -1 - code point of an unknown character
    logp: np.ndarray  # log probability of the edge, given its node
    reach: np.ndarray  # running sum of the node's probabilities; 1 at its last edge

    def choose(self, nodes: np.ndarray, u: np.ndarray) -> np.ndarray:
        """An edge of each node by its uniform number; nodes must not be ends of words."""
        edge = self.begin[nodes]
        more = np.flatnonzero(self.reach[edge] <= u)
        while len(more):
            edge[more] += 1
            more = more[self.reach[edge[more]] <= u[more]]
        return edge


def build(words: list[str], table: PieceTable, theta: float) -> Lattices:
    lengths = np.array([len(w) for w in words], np.int64)
    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    ends = np.cumsum(lengths + 1) - 1  # every word has a node more than characters
    first = ends - lengths
    node = np.arange(len(codes)) + np.repeat(np.arange(len(words)), lengths)  # of each character
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(codes))  # characters to the word's end
    starts, tos, numbers = [], [], []
    single = np.zeros(len(codes), bool)
    at, state, n = np.arange(len(codes)), np.zeros(len(codes), np.int64), 0
    while len(at):
        state = table.step(state, codes[at + n])
        on = state > 0
        at, state, n = at[on], state[on], n + 1
        piece = table.piece[state]
        whole = piece >= 0
        starts.append(at[whole])
        tos.append(node[at[whole]] + n)
        numbers.append(piece[whole])
        if n == 1:
            single[at[whole]] = True
        on = left[at] > n
        at, state = at[on], state[on]
    lost = np.flatnonzero(~single)
    starts.append(lost)
    tos.append(node[lost] + 1)
    numbers.append(-1 - codes[lost])
    # Long pieces first: they are the likelier ones, and choosing tries a node's edges in turn.
    start, to, piece = (np.concatenate(x[::-1]) for x in (starts, tos, numbers))
    weight = theta * table.scores[np.where(piece >= 0, piece, -1)]
    order = np.argsort(start, kind="stable")
    start, to, piece, weight = node[start[order]], to[order], piece[order], weight[order]
    n_nodes = int(ends[-1]) + 1 if len(words) else 0
    begin = np.concatenate([[0], np.cumsum(np.bincount(start, minlength=n_nodes))])
    # Log weight of everything from a node on, from the words' ends backwards.
    beta = np.zeros(n_nodes)
    by_left = np.argsort(left, kind="stable")
    cuts = np.searchsorted(left[by_left], np.arange(1, int(left.max(initial=0)) + 2))
    value = np.zeros(len(start))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        nodes = node[by_left[a:b]]
        low, count = begin[nodes], begin[nodes + 1] - begin[nodes]
        offsets = np.cumsum(count) - count
        edges = np.repeat(low - offsets, count) + np.arange(count.sum())
        v = weight[edges] + beta[to[edges]]
        top = np.maximum.reduceat(v, offsets)
        beta[nodes] = top + np.log(np.add.reduceat(np.exp(v - np.repeat(top, count)), offsets))
        value[edges] = v
    logp = np.minimum(value - beta[start], 0.0)
    total = np.cumsum(np.exp(logp))
    before = np.append(0.0, total)[begin[start]]
    reach = total - before
    counts = np.diff(begin)
    reach[begin[1:][counts > 0] - 1] = 1.0
    logp[counts[start] == 1] = 0.0
    return Lattices(first, ends, begin, start, to, piece, logp, reach)


def uniform(seed: np.ndarray, path: int, word: np.ndarray, step: np.ndarray | int, use: int) -> np.ndarray:
    """Numbers in (0, 1) that depend on the row's seed and the place in the search only."""
    x = seed + np.asarray(word, np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = mix(x + np.asarray(step, np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(8 * path + use))
    return np.clip((x >> np.uint64(11)).astype(np.float64) * 2.0**-53, 1e-15, 1 - 1e-15)


def walk(
    lat: Lattices, nodes: np.ndarray, ends: np.ndarray, seed: np.ndarray, word: np.ndarray, step: np.ndarray, path: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sample all words from the given nodes to their ends: (edges, steps in the word, words' counts)."""
    live = np.flatnonzero(nodes < ends)
    rounds = []
    counts = np.zeros(len(nodes), np.int64)
    nodes = nodes.copy()
    while len(live):
        edge = lat.choose(nodes[live], uniform(seed[live], path, word[live], step[live] + counts[live], 0))
        rounds.append((live, edge))
        nodes[live] = lat.to[edge]
        counts[live] += 1
        live = live[nodes[live] < ends[live]]
    at = np.cumsum(counts) - counts
    edges, steps = np.zeros(counts.sum(), np.int64), np.zeros(counts.sum(), np.int64)
    for r, (live, edge) in enumerate(rounds):
        edges[at[live] + r] = edge
        steps[at[live] + r] = step[live] + r
    return edges, steps, counts


@dataclass
class Path:
    """One found path of every text that has it, from the place where it left its parent."""

    bounds: np.ndarray  # where each text's steps begin; one more at the end
    edges: np.ndarray
    word: np.ndarray  # word number in the slice
    step: np.ndarray  # in the word
    before: np.ndarray  # log probability of the path up to the step
    gone: list[list[int]]  # per text: edges already taken at its first step
    value: np.ndarray  # noisy log probability; -inf where a text has no such path
    rest: np.ndarray  # noisy maximum over the edges not taken at each step
    parent: np.ndarray  # path number that it left, and how many of the parent's own steps it keeps
    keep: np.ndarray


def _untaken(lat: Lattices, left: np.ndarray, edges: np.ndarray, before: np.ndarray, value: np.ndarray, u: np.ndarray):
    """Noisy maximum over what is not taken at a step, given that it lies below ``value``."""
    with np.errstate(divide="ignore"):
        place = before + np.log(np.maximum(left, 0.0))
    # Sums of logs that run over probability 1 by rounding would make a branch out of nothing.
    place = np.where(left > 1e-12, place, -np.inf)
    return place - np.log(np.exp(place - value) - np.log(u))


class Search:
    """The k + 1 best noisy paths of all texts of a slice, the last one by its value only."""

    def __init__(self, lat: Lattices, word_ids: np.ndarray, bounds: np.ndarray, seeds: np.ndarray) -> None:
        self.lat, self.ids, self.bounds = lat, word_ids, bounds
        self.n = len(bounds) - 1
        counts = np.diff(bounds)
        self.text = np.repeat(np.arange(self.n), counts)
        self.seed = seeds[self.text]
        self.place = np.arange(len(word_ids)) - np.repeat(bounds[:-1], counts)  # of a word in its text
        self.seeds = seeds
        self.paths: list[Path] = []

    def _path(self, texts, words, nodes, steps, lead, before, value, number, gone, parent, keep) -> Path:
        """Sample on from the given nodes. ``lead`` is one edge per text that comes first."""
        lat = self.lat
        edges, step, counts = walk(
            lat, nodes, lat.last[self.ids[words]], self.seed[words], self.place[words], steps, number
        )
        word = np.repeat(words, counts)
        text = self.text[word]
        if lead is not None:
            lead_edge, lead_word, lead_step = lead
            # The first edge stands before all the text's other steps.
            slot = np.searchsorted(text, texts)
            edges = np.insert(edges, slot, lead_edge)
            step = np.insert(step, slot, lead_step)
            word = np.insert(word, slot, lead_word)
            text = np.insert(text, slot, texts)
        cut = np.searchsorted(text, np.arange(self.n + 1))
        own = lat.logp[edges]
        total = np.cumsum(own)
        base = np.append(0.0, total)[cut[:-1]]
        at = before[text] + (total - own - base[text])
        left = 1.0 - np.exp(own)
        if lead is not None:
            first = cut[texts]
            taken = np.array([np.exp(lat.logp[g]).sum() for g in (gone[t] for t in texts)])
            left[first] = 1.0 - taken
        if lead is not None:
            node = lat.start[edges[first]]
            full = lat.begin[node + 1] - lat.begin[node] == np.array([len(gone[t]) for t in texts])
            left[first[full]] = 0.0
        u = uniform(self.seeds[text], number, self.place[word], step, 1)
        rest = _untaken(lat, left, edges, at, value[text], u)
        return Path(cut, edges, word, step, at, gone, value, rest, parent, keep)

    def run(self, k: int) -> np.ndarray:
        """Find k paths and return the noisy value of the next one."""
        lat, n = self.lat, self.n
        words = np.arange(len(self.ids))
        u = uniform(self.seeds, 0, 0, 0, 2)
        value = -np.log(-np.log(u))
        none = np.full(n, -1)
        self.paths.append(
            self._path(
                np.arange(n), words, lat.first[self.ids], np.zeros(len(words), np.int64), None,
                np.zeros(n), value, 0, [[] for _ in range(n)], none, none,
            )
        )
        for number in range(1, k + 1):
            best, who, where = np.full(n, -np.inf), np.full(n, -1), np.full(n, -1)
            for p, path in enumerate(self.paths):
                has = np.flatnonzero(np.diff(path.bounds) > 0)
                if not len(has):
                    continue
                top = np.full(n, -np.inf)
                top[has] = np.maximum.reduceat(path.rest, path.bounds[has])
                for t in np.flatnonzero(top > best):
                    a, b = path.bounds[t], path.bounds[t + 1]
                    best[t], who[t], where[t] = top[t], p, a + int(np.argmax(path.rest[a:b]))
            if number == k:
                return best
            self._branch(number, best, who, where)
        raise ValueError("k must be at least 1")

    def _branch(self, number: int, best: np.ndarray, who: np.ndarray, where: np.ndarray) -> None:
        lat, n = self.lat, self.n
        texts = np.flatnonzero(who >= 0)
        gone: list[list[int]] = [[] for _ in range(n)]
        lead_edge, lead_word, lead_step = (np.zeros(len(texts), np.int64) for _ in range(3))
        before, keep = np.zeros(n), np.zeros(n, np.int64)
        u = uniform(self.seeds, number, 0, 0, 3)
        for i, t in enumerate(texts):
            path, at = self.paths[who[t]], where[t]
            start = path.bounds[t]
            taken = path.gone[t] if at == start and path.gone[t] else [int(path.edges[at])]
            node = lat.start[path.edges[at]]
            open_edges = [e for e in range(lat.begin[node], lat.begin[node + 1]) if e not in taken]
            p = np.exp(lat.logp[open_edges])
            edge = open_edges[min(int(np.searchsorted(np.cumsum(p), u[t] * p.sum(), side="right")), len(p) - 1)]
            gone[t] = [*taken, edge]
            lead_edge[i], lead_word[i], lead_step[i] = edge, path.word[at], path.step[at]
            before[t], keep[t] = path.before[at], at - start
            path.rest[at] = -np.inf  # the new path's first step holds what is left of this branch
        # On from there: the rest of the branch's word, then all later words of the text.
        later = self.bounds[texts + 1] - lead_word
        first_at = np.cumsum(later) - later
        words = np.repeat(lead_word - first_at, later) + np.arange(later.sum())
        nodes = lat.first[self.ids[words]].copy()
        steps = np.zeros(len(words), np.int64)
        nodes[first_at], steps[first_at] = lat.to[lead_edge], lead_step + 1
        value = np.where(who >= 0, best, -np.inf)
        self.paths.append(
            self._path(
                texts, words, nodes, steps, (lead_edge, lead_word, lead_step),
                before, value, number, gone, who, keep,
            )
        )

    def parts(self, number: int, t: int) -> list[np.ndarray]:
        """All edges of a path, with those that it shares with its parents, in order."""
        path, tail, parts = self.paths[number], None, []
        while True:
            a, b = path.bounds[t], path.bounds[t + 1]
            parts.append(path.edges[a : b if tail is None else a + tail])
            if path.parent[t] < 0:
                return parts[::-1]
            tail, path = path.keep[t], self.paths[path.parent[t]]

    def log_probabilities(self, number: int) -> np.ndarray:
        path = self.paths[number]
        out = np.zeros(self.n)
        has = np.flatnonzero(np.diff(path.bounds) > 0)
        last = path.bounds[has + 1] - 1
        out[has] = path.before[last] + self.lat.logp[path.edges[last]]
        return out


class Ids:
    """Edges to piece ids, and piece ids back to text."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.normal = np.array(vocabulary.ids, np.int64)
        size = max([*vocabulary.ids, *vocabulary.byte_ids, vocabulary.unknown_id]) + 1
        spelled = [b""] * size
        spelled[vocabulary.unknown_id] = " ⁇ ".encode()
        for i, p in zip(vocabulary.ids, vocabulary.pieces, strict=True):
            spelled[i] = p.replace(MARK, " ").encode()
        for b, i in enumerate(vocabulary.byte_ids):
            spelled[i] = bytes([b])
        self.length = np.array([len(s) for s in spelled], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.raw = np.frombuffer(b"".join(spelled), np.uint8)

    def of_pieces(self, piece: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of texts' piece numbers, and their bounds; unknown characters are spelled out."""
        lost = np.flatnonzero(piece < 0)
        count = np.ones(len(piece), np.int64)
        chars, which = np.unique(piece[lost], return_inverse=True)
        spelled = [self.vocabulary.unknown(chr(-1 - int(c))) for c in chars]
        count[lost] = np.array([len(x) for x in spelled], np.int64)[which] if len(lost) else 0
        if not self.vocabulary.byte_ids and len(lost):
            # Without byte pieces a run of unknown characters is one unknown piece.
            first = np.zeros(len(piece) + 1, bool)
            first[bounds] = True
            count[lost[(lost > 0) & (piece[lost - 1] < 0) & ~first[lost]]] = 0
        at = np.cumsum(count) - count
        out = np.zeros(count.sum(), np.int64)
        out[at[piece >= 0]] = self.normal[piece[piece >= 0]]
        for c, ids in enumerate(spelled):
            places = at[lost[(which == c) & (count[lost] > 0)]]
            for i, one in enumerate(ids):
                out[places + i] = one
        return out, np.append(0, np.cumsum(count))[bounds]

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """Texts that the ids between the bounds spell, without the space in front."""
        length = self.length[ids]
        ends = np.cumsum(length)
        where = np.repeat(self.start[ids] - (ends - length), length) + np.arange(length.sum())
        text, cut = self.raw[where].tobytes(), np.append(0, ends)[bounds].tolist()
        return [
            text[a + (text[a : a + 1] == b" " and a < b) : b] for a, b in zip(cut[:-1], cut[1:], strict=True)
        ]


def decode(rows: DataFrame, vocabulary: Vocabulary, pieces: str = "pieces", to: str = "text") -> DataFrame:
    """The rows with a column ``to`` (replaced if there) of the texts that the pieces spell.

    The space in front that encoding adds is taken off; marks become spaces. Bytes that are not
    UTF-8 decode to the replacement character, null pieces to null, no pieces to an empty text.
    """
    kept = [c for c in rows.columns if c != to]
    source = rows.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{pieces}`").alias("_pieces"))
    schema = rows.select(*[F.col(f"`{c}`") for c in kept], F.lit("").alias(to)).schema
    sent = rows.sparkSession.sparkContext.broadcast(vocabulary)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = Ids(sent.value)
        for batch in batches:
            found = [
                None if p is None else ids.decode(np.array(p, np.int64), np.array([0, len(p)]))[0].decode("utf-8", "replace")
                for p in batch.column(len(kept)).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(kept)], pa.array(found, pa.string())], names=[*kept, to]
            )

    return source.mapInArrow(apply, schema)


@dataclass
class Samples:
    """Sampled segmentations, text by text."""

    text: np.ndarray  # text number
    rank: np.ndarray
    ids: np.ndarray
    bounds: np.ndarray  # of each sample's ids
    log_prob: np.ndarray
    noisy: np.ndarray
    inclusion: np.ndarray


def encode_slice(
    texts: list[str], seeds: np.ndarray, table: PieceTable, ids: Ids, k: int, theta: float
) -> Samples:
    """k distinct segmentations of each text, or all where there are fewer."""
    numbers: dict[str, int] = {}
    word_ids, bounds = [], [0]
    for text in texts:
        word_ids += [numbers.setdefault(w, len(numbers)) for w in marked_words(text)]
        bounds.append(len(word_ids))
    lat = build(list(numbers), table, theta)
    search = Search(lat, np.array(word_ids, np.int64), np.array(bounds), seeds)
    kappa = search.run(k)
    noisy = np.stack([p.value for p in search.paths], axis=1)
    log_prob = np.stack([search.log_probabilities(i) for i in range(k)], axis=1)
    text, path = np.nonzero(noisy > -np.inf)
    parts = [search.parts(i, t) for t, i in zip(text.tolist(), path.tolist(), strict=True)]
    lengths = [sum(map(len, p)) for p in parts]
    edges = np.concatenate([e for p in parts for e in p]) if parts else np.zeros(0, np.int64)
    found, cut = ids.of_pieces(lat.piece[edges], np.append(0, np.cumsum(lengths)).astype(np.int64))
    log_prob, noisy = log_prob[text, path], noisy[text, path]
    with np.errstate(over="ignore"):
        inclusion = -np.expm1(-np.exp(log_prob - kappa[text]))  # 1 where nothing had to be beaten
    return Samples(text, path + 1, found, cut, log_prob, noisy, inclusion)


def sample_encode(
    docs: DataFrame,
    vocabulary: Vocabulary,
    k: int = 2,
    theta: float = 1.0,
    seed: int = 0,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(key, rank, pieces, log_prob, noisy, inclusion, decodes): k distinct segmentations per row.

    Ranks go by the noisy log probability. ``inclusion`` is the chance that a path is among the
    first k given the value that it had to beat; 1 / inclusion weights a path's log_prob so that
    sums over sampled paths estimate sums over all. ``decodes`` tells whether the pieces spell the
    text (with marks as spaces). Noise is seeded by ``seed`` and the row's key, so a row gets the
    same samples in any batch, partition or run, and rows with one key and text the same ones.

    A text with fewer than k segmentations gives all of them, an empty text one without pieces,
    a null text no row. Null keys share a seed. An empty table gives an empty result; other
    columns are ignored. Row by row, no shuffle.
    """
    kind = docs.select(F.col(f"`{key}`")).schema[0].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast((PieceTable(vocabulary), Ids(vocabulary)))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, ids = sent.value
        for rows, _, _ in text_slices(batches, limit=SLICE):
            texts = rows.column(2).to_pylist()
            seeds = rows.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            found = encode_slice(texts, seeds, table, ids, k, theta)
            want = [t.replace(MARK, " ").encode() for t in texts]
            spelled = ids.decode(found.ids, found.bounds)
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0).take(pa.array(found.text)),
                    pa.array(found.rank.astype(np.int32)),
                    pa.ListArray.from_arrays(
                        pa.array(found.bounds.astype(np.int32)), pa.array(found.ids.astype(np.int32))
                    ),
                    pa.array(found.log_prob),
                    pa.array(found.noisy),
                    pa.array(found.inclusion),
                    pa.array([want[t] == s for t, s in zip(found.text.tolist(), spelled, strict=True)], pa.bool_()),
                ],
                names=["id", "rank", "pieces", "log_prob", "noisy", "inclusion", "decodes"],
            )

    rows = docs.where(F.col(f"`{text}`").isNotNull()).select(
        F.col(f"`{key}`").alias("id"),
        F.xxhash64(F.lit(seed), F.col(f"`{key}`").cast("string")).alias("seed"),
        F.col(f"`{text}`").alias("text"),
    )
    schema = f"id {kind}, rank int, pieces array<int>, log_prob double, noisy double, inclusion double, decodes boolean"
    return rows.mapInArrow(apply, schema).withColumnRenamed("id", key)
