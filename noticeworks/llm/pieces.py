"""Sampled segmentations into SentencePiece pieces, and their decoding.

The segmentations of a text are the paths of a lattice whose edges are the vocabulary's
pieces. A path's probability is proportional to the product of its pieces' weights. Gumbel
top-k draws k different paths without replacement: the whole set of paths gets a Gumbel
variable, its largest, and a path drawn from it; what is left of the set splits by the first
edge that differs from that path, each part with a Gumbel variable of its own, truncated at
its parent's. The search always opens the part whose variable is largest, as A* does with the
parts' total masses as exact bounds, so paths come in the order of their perturbed scores.
The first variable not drawn gives each path's inclusion probability.

The vocabulary's merge order serves as its rank, and a piece of rank r has the weight
(r + offset) ** -power, as in Zipf's law. No piece has a space or a line end after its first
letters, so lattices are built per word, once for all equal words of a block of texts, and
the text's lattice is their row. Random numbers are functions of the row's key, the sample and
the place, so a row's result depends on nothing else.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeworks.llm.common import table

SPACE = "▁"
#: Words of any length: no piece crosses from one to the next.
_UNIT = re.compile(f"{SPACE}*+[^{SPACE}\n]+|{SPACE}+|\n")
#: Masses up to so many code points before a word's end fit doubles; farther away they are logarithms.
_NEAR = 64
#: Steps of a draw that are joined to one array, so that long words don't leave an object a step.
_JOINED = 1024
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


@dataclass(frozen=True)
class Sampling:
    """``samples`` different segmentations of each text; ``power`` and ``offset`` shape the
    weights (a large power prefers frequent pieces). ``block``: characters handled at once."""

    samples: int = 2
    power: float = 1.0
    offset: float = 10.0
    seed: int = 0
    block: int = 5_000_000


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


def _chained(h: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Hash of a prefix and its next code point."""
    h = (h + point + np.uint64(1)) * _A
    return h ^ (h >> np.uint64(29))


def _uniform(x: np.ndarray) -> np.ndarray:
    """Uniform in (0, 1) from 64-bit keys."""
    return ((_mix(x) >> np.uint64(12)).astype(np.float64) + 0.5) * 2.0**-52


class Vocabulary:
    """Pieces, their weights per code point, and a table of all their prefixes by hash."""

    def __init__(self, path: str, power: float, offset: float):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(n)]
        self.bytes_from = next(i for i in range(n) if model.is_byte(i))
        normal = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        if any(SPACE in p.lstrip(SPACE) or "\n" in p for p in (self.pieces[i] for i in normal)):
            raise ValueError("pieces cross words")
        ranks = np.arange(len(normal)) + 1.0
        weights = (ranks + offset) ** -power
        # all paths of a word have its length, so a factor per code point changes nothing but the size of the numbers
        self.scale = float(np.exp(-np.mean(np.log(weights)) / 3.0))
        self.longest = max(len(self.pieces[i]) for i in normal)
        # a code point spelled in bytes weighs as little as the last piece
        self.spelled_weight = float((len(normal) + offset) ** -power) * self.scale
        if min(self.spelled_weight, 1.0) ** _NEAR < 1e-290:
            raise ValueError("power too large: masses of long words would vanish")
        table: dict[int, tuple[int, float]] = {}
        for i, w in zip(normal, weights, strict=True):
            points = np.frombuffer(self.pieces[i].encode("utf-32-le"), np.uint32).astype(np.uint64)
            h = np.zeros(1, np.uint64)
            for at, c in enumerate(points):
                h = _chained(h, c)
                key = int(h[0])
                if at == len(points) - 1:
                    table[key] = (i, w * self.scale ** len(points))
                else:
                    table.setdefault(key, (-1, 0.0))
        keys = np.array(list(table), np.uint64)
        self.keys = np.append(keys, np.uint64(0))
        self.ids = np.array([*(table[int(k)][0] for k in keys), -1], np.int32)
        self.weights = np.array([*(table[int(k)][1] for k in keys), 0.0])
        # open addressing by the hash's first bits; free slots name the empty entry at the end
        self.slots = np.full((1 << 20) + 64, len(keys), np.int32)
        self.probes = 1
        for i, slot in enumerate((keys >> np.uint64(44)).tolist()):
            tries = 0
            while self.slots[slot + tries] != len(keys):
                tries += 1
            self.slots[slot + tries] = i
            self.probes = max(self.probes, tries + 1)
        self.text = [p.replace(SPACE, " ").encode() for p in self.pieces]
        for b in range(256):
            self.text[self.bytes_from + b] = bytes([b])
        # all pieces' bytes one after another, and where each begins
        self.letters = np.frombuffer(b"".join(self.text), np.uint8)
        self.sizes = np.fromiter(map(len, self.text), np.int32, n)
        self.begins = (np.cumsum(self.sizes) - self.sizes).astype(np.int32)


    def find(self, h: np.ndarray) -> np.ndarray:
        """The entry of each hash; the empty one where there is none."""
        slot = (h >> np.uint64(44)).astype(np.int64)
        found = self.slots[slot]
        for tries in range(1, self.probes):
            wrong = np.flatnonzero((self.keys[found] != h) & (found < len(self.keys) - 1))
            if not len(wrong):
                return found
            found[wrong] = self.slots[slot[wrong] + tries]
        found[self.keys[found] != h] = len(self.keys) - 1
        return found


@lru_cache(maxsize=2)
def vocabulary(path: str, power: float, offset: float) -> Vocabulary:
    return Vocabulary(path, power, offset)


class Lattice:
    """Lattices of words side by side. Positions are code points of all words; edges of one
    position stand together: from, to, id (below 0: -1 less a code point, spelled in bytes), p (given the
    position, over all ways to the word's end), and bounds to draw one by."""

    def __init__(self, words: list[str], v: Vocabulary):
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        self.ends = np.cumsum(lengths)
        self.starts = self.ends - lengths
        word = np.repeat(np.arange(len(words)), lengths)
        end = self.ends[word]
        at, h = np.arange(len(points)), np.zeros(len(points), np.uint64)
        found = []
        for size in range(1, v.longest + 1):
            fits = at + size <= end[at]
            at, h = at[fits], h[fits]
            h = _chained(h, points[at + size - 1])
            j = v.find(h)
            known = j < len(v.keys) - 1
            if size == 1:
                piece = known & (v.ids[j] >= 0)
                spelled = at[~piece]
                found.append((spelled, np.ones(len(spelled), np.int64), -1 - points[spelled].astype(np.int64), np.full(len(spelled), v.spelled_weight)))
            at, h, j = at[known], h[known], j[known]
            own = v.ids[j] >= 0
            found.append((at[own], np.full(int(own.sum()), size), v.ids[j[own]].astype(np.int64), v.weights[j[own]]))
            if not len(at):
                break
        source, size, ids, w = (np.concatenate(x) for x in zip(*found, strict=True))
        # mass of all ways from a position to its word's end, from the shortest rest on
        mass = np.ones(len(points) + 1)
        log_mass = None
        rest = end[source] - source
        # longer pieces first: they mostly are the likelier ones, and draws look at one after another
        order = np.argsort((rest * len(points) + source) * 128 + (127 - size))
        source, size, ids, w, rest = source[order], size[order], ids[order], w[order], rest[order]
        cuts = np.searchsorted(rest, np.arange(1, int(rest.max(initial=0)) + 2))
        target = source + size
        last = size == rest
        starts = np.flatnonzero(np.diff(source, prepend=-1))
        groups = np.searchsorted(starts, cuts)
        for far, (a, b, i, j) in enumerate(zip(cuts[:-1], cuts[1:], groups[:-1], groups[1:], strict=True), 1):
            if a < b and far > _NEAR:
                if log_mass is None:
                    log_mass, log_w = np.log(mass), np.log(w)
                value = log_w[a:b] + np.where(last[a:b], 0.0, log_mass[target[a:b]])
                log_mass[source[starts[i:j]]] = np.logaddexp.reduceat(value, starts[i:j] - a)
            elif a < b:
                value = w[a:b] * mass[target[a:b]]
                value[last[a:b]] = w[a:b][last[a:b]]
                mass[source[starts[i:j]]] = np.add.reduceat(value, starts[i:j] - a)
        p = w * np.where(last, 1.0, mass[target]) / mass[source]
        past = np.append(starts[1:], len(p))
        if log_mass is not None:
            a, i = cuts[_NEAR], groups[_NEAR]
            away = np.exp(log_w[a:] + np.where(last[a:], 0.0, log_mass[target[a:]]) - log_mass[source[a:]])
            # exactly 1 for a lone edge, however far the word's end
            p[a:] = away / np.repeat(np.add.reduceat(away, starts[i:] - a), (past - starts)[i:])
        total = np.cumsum(p)
        within = total - np.repeat(total[starts] - p[starts], past - starts)
        within[past - 1] = 2.0
        # where each position's edges begin and end; every position has one
        self.first, self.past = np.empty(len(points), np.int64), np.empty(len(points), np.int64)
        self.first[source[starts]], self.past[source[starts]] = starts, past
        self.source, self.target, self.ids, self.p = source, target, ids, p
        self.bounds = within
        self.log_p = np.log(p)
        self.word_end = end

    def draw(self, at: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Edges of a path from each position to its word's end, position after position, and
        how many each. Keys are 64-bit seeds, one for each."""
        steps, joined, who = [], [], np.arange(len(at))
        taken = np.zeros(len(at), np.int64)
        step = 0
        while len(who):
            u = _uniform(keys + np.uint64((step + 1) * int(_C) & 0xFFFFFFFFFFFFFFFF))
            e = self.first[at]
            behind = np.flatnonzero(self.bounds[e] <= u)
            while len(behind):
                e[behind] += 1
                behind = behind[self.bounds[e[behind]] <= u[behind]]
            steps.append((who, e))
            taken[who] += 1
            go = self.target[e] < self.word_end[self.source[e]]
            who, at, keys = who[go], self.target[e][go], keys[go]
            step += 1
            if len(steps) == _JOINED:
                sizes = [len(x) for x, _ in steps]
                joined.append((*(np.concatenate(x) for x in zip(*steps, strict=True)), np.repeat(np.arange(step - _JOINED, step), sizes)))
                steps = []
        place = np.cumsum(taken) - taken
        out = np.empty(int(taken.sum()), np.int64)
        for who, e, i in joined:
            out[place[who] + i] = e
        for i, (who, e) in enumerate(steps, _JOINED * len(joined)):
            out[place[who] + i] = e
        return out, taken


_NONE = np.zeros(1)


def _gumbel(u: np.ndarray) -> np.ndarray:
    return -np.log(-np.log(u))


class _Search:
    """One text's search: paths found, and parts of what is left with their variables."""

    def __init__(self, key: int, lattice: Lattice, seed: np.ndarray):
        self.key, self.lattice, self.seed = key, lattice, seed
        self.paths: list[np.ndarray] = []
        self.scores: list[tuple[float, float]] = []  # log probability and variable
        self.parts: list[tuple[np.ndarray, int, int, tuple[int, ...]]] = []  # variables, path, first step, edges barred at it

    def add(self, path: np.ndarray, variable: float, first: int, barred: tuple[int, ...]) -> None:
        before = np.concatenate((_NONE, np.cumsum(self.lattice.log_p[path])))
        # beyond, all parts together are less than 2**-64 of the whole, which doubles don't tell from 1
        last = min(len(path), int(np.searchsorted(-before, 45.0, side="right")))
        last = max(last, min(first + 1, len(path)))
        left = 1.0 - self.lattice.p[path[first:last]]
        if first < last and barred:
            left[0] -= self.lattice.p[list(barred)].sum()
        left[left < 1e-13] = 0.0
        with np.errstate(divide="ignore"):
            masses = before[first:last] + np.log(left)
        keys = self.seed + np.array([len(self.paths) + 1], np.uint64) * _A + (np.arange(first, last).astype(np.uint64) + np.uint64(1)) * _B
        fresh = masses + _gumbel(_uniform(keys))
        self.parts.append((-np.logaddexp(-variable, -fresh), len(self.paths), first, barred))
        self.paths.append(path)
        self.scores.append((float(before[-1]), variable))

    def best(self) -> tuple[float, int, int] | None:
        """The largest variable left, its part and the step in it."""
        found = [(float(g.max()), i, int(g.argmax())) for i, (g, *_) in enumerate(self.parts) if len(g)]
        top = max(found, default=None)
        return top if top is not None and top[0] > -np.inf else None


def sample_block(texts: list[str], keys: list[int], v: Vocabulary, options: Sampling) -> list[list[tuple[np.ndarray, float, float, float]]]:
    """For each text its distinct segmentations in order of their perturbed scores: edges' ids
    (below 0: spelled code points), log probability, variable and log inclusion probability."""
    split = [_UNIT.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
    words = list(itertools.chain.from_iterable(split))
    if not words:
        return [[] for _ in texts]
    distinct = list(dict.fromkeys(words))
    lattice = Lattice(distinct, v)
    flat = np.fromiter(map(dict(zip(distinct, range(len(distinct)), strict=True)).__getitem__, words), np.int64, len(words))
    seeds = _mix(np.array(keys, np.uint64) + np.uint64(options.seed) * _A)
    searches = [_Search(k, lattice, s) for k, s in zip(keys, seeds[:, None], strict=True)]
    counts = np.fromiter(map(len, split), np.int64, len(texts))
    place = np.arange(len(flat)) - np.repeat(np.cumsum(counts) - counts, counts)
    base = _mix(np.repeat(seeds, counts) ^ ((place.astype(np.uint64) + np.uint64(1)) * _A))
    edges, taken = lattice.draw(lattice.starts[flat], base)
    cuts = np.concatenate(([0], np.cumsum(taken)))[np.concatenate(([0], np.cumsum(counts)))]
    for i, s in enumerate(searches):
        if counts[i]:
            s.add(edges[cuts[i] : cuts[i + 1]], float(_gumbel(_uniform(s.seed ^ _C))[0]), 0, ())
    offsets = np.cumsum(counts) - counts
    for sample in range(1, options.samples):
        begun, at, seeded, sizes = [], [], [], []
        for i, s in enumerate(searches):
            top = s.best() if s.paths else None
            if top is None:
                continue
            variable, part, step = top
            g, path, first, barred = s.parts[part]
            g[step] = -np.inf
            t = first + step
            known = s.paths[path]
            barred = (*(barred if not step else ()), int(known[t]))
            position = lattice.source[known[t]]
            a, b = lattice.first[position], lattice.past[position]
            p = lattice.p[a:b].copy()
            p[np.array(barred) - a] = 0.0
            u = _uniform(s.seed ^ (np.array([sample], np.uint64) * _B))[0]
            other = a + min(int(np.searchsorted(np.cumsum(p), u * p.sum(), side="right")), b - a - 1)
            # words ended before this step; the rest of this word, then all words after it, are drawn anew
            done = int(np.count_nonzero(lattice.target[known[:t]] == lattice.word_end[lattice.source[known[:t]]]))
            inside = lattice.target[other] < lattice.word_end[position]
            todo = flat[offsets[i] + done + 1 : offsets[i] + counts[i]]
            starts = lattice.starts[todo]
            own = base[offsets[i] + done : offsets[i] + counts[i]] ^ _mix(np.array([sample], np.uint64) * _C)
            at.append(np.concatenate(([lattice.target[other]], starts)) if inside else starts)
            seeded.append(own if inside else own[1:])
            sizes.append(len(at[-1]))
            begun.append((s, variable, t, barred, np.append(known[:t], other)))
        if not begun:
            break
        edges, taken = lattice.draw(np.concatenate(at), np.concatenate(seeded))
        cuts = np.concatenate(([0], np.cumsum(taken)))[np.concatenate(([0], np.cumsum(sizes)))]
        for n, (s, variable, t, barred, head) in enumerate(begun):
            s.add(np.concatenate((head, edges[cuts[n] : cuts[n + 1]])), variable, t, barred)
    results = []
    for s in searches:
        top = s.best() if s.paths else None
        rows = []
        for path, (log_p, variable) in zip(s.paths, s.scores, strict=True):
            # 1 - exp(-exp(x)), in logarithms; certain if nothing is left out
            x = log_p - top[0] if top is not None else np.inf
            log_inclusion = 0.0 if x > 30 else x if x < -30 else float(np.log(-np.expm1(-np.exp(x))))
            rows.append((lattice.ids[path], log_p, variable, log_inclusion))
        results.append(rows)
    return results


def spell(ids: np.ndarray, v: Vocabulary) -> np.ndarray:
    """Ids with spelled code points as their bytes' pieces."""
    odd = np.flatnonzero(ids < 0)
    if not len(odd):
        return ids
    spelled = [np.frombuffer(chr(-1 - int(c)).encode("utf-8", "surrogatepass"), np.uint8).astype(np.int64) + v.bytes_from for c in ids[odd]]
    if all(len(x) == 1 for x in spelled):
        ids = ids.copy()
        ids[odd] = np.concatenate(spelled)
        return ids
    parts, before = [], 0
    for at, x in zip(odd, spelled, strict=True):
        parts += [ids[before:at], x]
        before = at + 1
    return np.concatenate([*parts, ids[before:]])


def decoded(ids: np.ndarray, v: Vocabulary) -> bytes:
    """The text of ids in UTF-8, without the space that encoding puts before it."""
    sizes = v.sizes[ids]
    ends = np.cumsum(sizes, dtype=np.int32)
    if not len(ends):
        return b""
    at = np.repeat(v.begins[ids] - (ends - sizes), sizes)
    at += np.arange(ends[-1], dtype=np.int32)
    return v.letters[at].tobytes()[1:]


def decode(ids: np.ndarray, v: Vocabulary) -> str:
    return decoded(ids, v).decode("utf-8", "surrogatepass")


_SCHEMA = "doc_id long, sample int, ids array<int>, log_prob double, perturbed double, log_inclusion double"


def _each_block(batch: pd.DataFrame, options: Sampling) -> Iterator[tuple[list, list[str]]]:
    docs, texts, size = [], [], 0
    for doc, text in zip(batch["doc_id"], batch["text"], strict=True):
        docs.append(None if pd.isna(doc) else int(doc))
        texts.append(text)
        size += len(text)
        if size >= options.block:
            yield docs, texts
            docs, texts, size = [], [], 0
    if docs:
        yield docs, texts


def _sampled(batch: pd.DataFrame, path: str, options: Sampling):
    v = vocabulary(path, options.power, options.offset)
    for docs, texts in _each_block(batch, options):
        keys = [xxhash.xxh3_64_intdigest(str(d)) for d in docs]
        for doc, text, rows in zip(docs, texts, sample_block(texts, keys, v, options), strict=True):
            for n, (ids, *scores) in enumerate(rows):
                yield doc, text, n, spell(ids, v), scores


def _prepared(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def encode_samples(docs: DataFrame, path: str, options: Sampling | None = None) -> DataFrame:
    """A row for each document and sampled segmentation: doc_id, sample (from 0, by falling
    perturbed score), ids, log_prob, perturbed, log_inclusion.

    A text has as many rows as it has segmentations, if fewer than asked; null and empty texts
    have none. Rows with the same doc_id are seeded alike, a null doc_id like any other value.
    Each row for itself, nothing is shuffled; columns other than doc_id and text are ignored.
    """
    options = options or Sampling()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(d, n, ids.astype(np.int32), *scores) for d, _, n, ids, scores in _sampled(batch, path, options)]
            yield pd.DataFrame(rows, columns=["doc_id", "sample", "ids", "log_prob", "perturbed", "log_inclusion"]).astype({"doc_id": "Int64"})

    return _prepared(docs).mapInPandas(run, _SCHEMA)


def decode_samples(encoded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """encoded with ``text``: what the ids spell. Null ids give null."""
    power, offset = Sampling().power, Sampling().offset

    @F.pandas_udf("string")
    def spelled(column: pd.Series) -> pd.Series:
        v = vocabulary(path, power, offset)
        return column.map(lambda x: None if x is None else decode(np.asarray(x), v))

    return encoded.withColumn("text", spelled(F.col(ids)))


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op7_gumbel_segmentations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: two segmentations of every whole text, digested after decoding them."""
    options, path = Sampling(), default_model()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        v = vocabulary(path, options.power, options.offset)
        for batch in batches:
            rows = []
            for doc, text, n, ids, (log_p, variable, inclusion) in _sampled(batch, path, options):
                rows.append((doc, n, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), log_p, variable, inclusion, decoded(ids, v) == text.encode("utf-8", "surrogatepass")))
            yield pd.DataFrame(rows, columns=["doc_id", "sample", "n_pieces", "ids_crc32", "log_prob", "perturbed", "log_inclusion", "round_trip"]).astype({"doc_id": "Int64"})

    docs = _prepared(table(spark, sf_dir, "documents"))
    return docs.mapInPandas(run, "doc_id long, sample int, n_pieces long, ids_crc32 long, log_prob double, perturbed double, log_inclusion double, round_trip boolean")
