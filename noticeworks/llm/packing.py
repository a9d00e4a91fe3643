"""Best-fit packing by bin completion.

Pieces are counted by length, which gives at most one count per length up to the sequence's,
whatever the corpus. On these counts bin completion runs as branch and bound over sequences:
the largest length left must be in some sequence, so the undominated fillings around it are
enumerated, those that waste least first, and each is tried as often as the counts allow, then
less often, with what is left below it. A filling is dominated if some of its lengths together
could give way to one greater or equal length that is left: what they were can then only be
easier to place. A branch is pruned where the waste so far and the lengths left need as many
sequences as the incumbent, and a filling where its own waste spends more than an improvement
may waste. The first incumbents are best-fit decreasing and a filling that wastes least after
another; the search ends when an incumbent meets the lower bound, when nothing is left to try
(then the plan is optimal), or after ``steps`` steps (then the plan is no worse than best-fit
decreasing). The plan is a table of fillings with multiplicities. Pieces are numbered within
their length by a distributed ranking and find their place by a join with the plan.
"""

from __future__ import annotations

import bisect
import itertools
import json
import os
import re
import struct
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeworks.llm.common import partitions, table, written
from noticeworks.llm.sharding import numbered

CAPACITY = 4096
#: Id at the end of each document.
END = 1
#: Distinct words whose ids a Python worker remembers, and as many of its cuts; beyond, it begins anew.
MEMORY = 800_000
#: Characters of text that are in words at once.
BLOCK = 2_000_000


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


#: Fixed: the settings of a tokenizer whose texts may be encoded word by word, and how it cuts
#: words, for letters below U+0250, whose case and normal form are the same everywhere; words
#: with others are encoded whole.
_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PRE_TOKENIZERS = [
    {"type": "Split", "pattern": {"Regex": _PATTERN}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]
_CUT = regex.compile(_PATTERN)
_ASCII_CUT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\x20\x09-\x0da-z0-9]+").findall
_SIMPLE = regex.compile(r"[\x00-\u024f]*").fullmatch


def by_words(path: str) -> bool:
    """Whether a tokenizer's own file says that its texts may be encoded word by word."""
    with open(path, encoding="utf-8") as f:
        given = json.load(f)
    marks = all("<|" in x["content"] and not (x["normalized"] or x["lstrip"] or x["rstrip"] or x["single_word"]) for x in given["added_tokens"])
    model, before, pre = given["model"], given["normalizer"] or {}, given["pre_tokenizer"] or {}
    plain = model["type"] == "BPE" and not model["dropout"] and given["truncation"] is None and given["padding"] is None
    return marks and plain and before.get("normalizers") == _NORMALIZERS and pre.get("pretokenizers") == _PRE_TOKENIZERS


class WordIds:
    """Ids of texts under a tokenizer that drops white space and ignores case; texts of any
    other tokenizer are encoded whole.

    What it merges never crosses ASCII white space nor its own cuts within a word, and doesn't
    depend on neighbours, so the ids of a text are those of its cuts, one after another. Words
    and cuts that occur again needn't be encoded again; a Python worker keeps them for its
    next tasks.
    """

    _LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))

    def __init__(self, path: str):
        self.tokenizer = _tokenizer(path)
        self.by_words = by_words(path)
        self.words: dict[bytes, bytes] = {}
        self.cuts: dict[str, bytes] = {}

    @staticmethod
    def cut(word: bytes) -> list[str]:
        if word.isalpha():
            return [word.decode()]
        text = word.decode("utf-8", "replace")
        # marks of special tokens are looked for before any cut
        if word.isascii() and b"<|" not in word:
            return _ASCII_CUT(text)
        return _CUT.findall(text.lower()) if "<|" not in text and _SIMPLE(text) else [text]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as unsigned little-endian 32-bit numbers."""
        if not self.by_words:
            return [struct.pack(f"<{len(e.ids)}I", *e.ids) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]
        if len(self.words) > MEMORY:
            self.words.clear()
        if len(self.cuts) > MEMORY:
            self.cuts.clear()
        words_of, cuts, cut = self.words.get, self.cuts, self.cut
        rows, new = [], {}
        for text in texts:
            words = text.encode("utf-8", "surrogatepass").translate(self._LOWER).split()
            ids = list(map(words_of, words))
            gaps = [(i, words[i]) for i, x in enumerate(ids) if x is None] if None in ids else ()
            new.update(dict.fromkeys(w for _, w in gaps))
            rows.append((ids, gaps))
        for w in new:
            new[w] = cut(w)
        fresh = [c for c in dict.fromkeys(itertools.chain.from_iterable(new.values())) if c not in cuts]
        for at in range(0, len(fresh), 20_000):
            part = fresh[at : at + 20_000]
            encoded = (e.ids for e in self.tokenizer.encode_batch(part, add_special_tokens=False))
            cuts.update((c, struct.pack(f"<{len(ids)}I", *ids)) for c, ids in zip(part, encoded, strict=True))
        for w, parts in new.items():
            new[w] = cuts[parts[0]] if len(parts) == 1 else b"".join([cuts[c] for c in parts])
        self.words.update(new)
        for ids, gaps in rows:
            for i, w in gaps:
                ids[i] = new[w]
        return [b"".join(ids) for ids, _ in rows]


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def pieces_of(docs: DataFrame, path: str, capacity: int = CAPACITY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Token pieces of every whole text, the end id included: doc_id, piece, start, length, ids_crc32.

    Only documents longer than the capacity are cut, into pieces as long as it.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = word_ids(path)
        end = np.array([END], "<u4").tobytes()
        for batch in batches:
            rows = []
            sizes = batch["text"].str.len().cumsum() // BLOCK
            for _, block in batch.groupby(sizes, sort=False):
                for doc, ids in zip(block["doc_id"], words.encode(block["text"].tolist()), strict=True):
                    ids += end
                    for piece, start in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[start : start + 4 * capacity]
                        rows.append((None if pd.isna(doc) else int(doc), piece, start // 4, len(part) // 4, zlib.crc32(part)))
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"]).astype({"doc_id": "Int64"})

    return docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).mapInPandas(
        cut, "doc_id long, piece int, start long, length long, ids_crc32 long"
    )


def complete_bin(lengths: list[int], left: dict[int, int], room: int, budget: int = 2_000) -> list[int]:
    """The filling of ``room`` that wastes least, by branch and bound; lengths ascending.

    Depth first, the greatest length that fits and as many of it as fit, so the first leaf is
    the best-fit decreasing filling, the first incumbent. Lengths go down along a branch. A
    dominated filling, which a greater length left would improve, comes after the one that
    dominates it and wastes more, so it never replaces the incumbent. A branch is pruned where
    the room beyond all that is left below its length is no better than the incumbent's waste.
    Ends at no waste, or with the incumbent after ``budget`` steps.
    """
    below = list(itertools.accumulate(size * left[size] for size in lengths))
    best = (room, [])
    steps = 0

    def go(room: int, i: int, chosen: list[int]) -> None:
        nonlocal best, steps
        if room < best[0]:
            best = (room, chosen)
        i = min(i, bisect.bisect_right(lengths, room) - 1)
        while i >= 0 and best[0] and steps < budget and room - below[i] < best[0]:
            size = lengths[i]
            for many in range(min(left[size], room // size), 0, -1):
                steps += 1
                go(room - many * size, i - 1, chosen + [size] * many)
                if not best[0] or steps >= budget:
                    return
            i -= 1

    go(room, len(lengths) - 1, [])
    return best[1]


Plan = list[tuple[list[int], int]]


def sequences_of(plan: Plan) -> int:
    return sum(times for _, times in plan)


def best_fit_decreasing(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """The plan of best-fit decreasing: each length, the largest first, goes where the least room
    is left that holds it. Sequences filled alike are one entry, so the work depends on the
    number of lengths and not on their counts."""
    rooms: dict[int, list[list]] = {}  # room left: [filling, times]
    for size in sorted((x for x, n in counts.items() if n), reverse=True):
        n = counts[size]
        moved = []
        for room in sorted(x for x in rooms if x >= size):
            # a sequence once begun is the tightest until it holds no more of the length
            each = room // size
            while n and rooms[room]:
                filling, times = rooms[room].pop()
                whole = min(times, n // each)
                n -= whole * each
                moved += [(room - each * size, filling + [size] * each, whole)] if whole else []
                if whole < times and n:
                    moved.append((room - n * size, filling + [size] * n, 1))
                    whole, n = whole + 1, 0
                if whole < times:
                    rooms[room].append([filling, times - whole])
            if not n:
                break
        each = capacity // size
        moved += [(capacity - each * size, [size] * each, n // each)] if n // each else []
        moved += [(capacity - n % each * size, [size] * (n % each), 1)] if n % each else []
        for room, filling, times in moved:
            rooms.setdefault(room, []).append([filling, times])
    return [(filling, times) for alike in rooms.values() for filling, times in alike]


def lower_bound(counts: dict[int, int], capacity: int = CAPACITY) -> int:
    """No packing has fewer sequences: the larger of the tokens' share and, for every size k,
    the lengths over half, which never meet, with what those from k up to half need beyond the
    room beside the ones that leave at least k."""
    sizes = sorted(size for size, n in counts.items() if n)
    many = [0, *itertools.accumulate(counts[size] for size in sizes)]
    total = [0, *itertools.accumulate(size * counts[size] for size in sizes)]
    half = bisect.bisect_right(sizes, capacity // 2)  # two of those before it fit together
    best = -(-total[-1] // capacity)
    for i in range(half + 1):
        k = sizes[i] if i < half else 0
        fit = bisect.bisect_right(sizes, capacity - k)  # those from half to here leave k or more
        room = (many[fit] - many[half]) * capacity - (total[fit] - total[half])
        small = total[half] - total[i if i < half else 0]
        best = max(best, many[-1] - many[half] + max(0, -(-(small - room) // capacity)))
    return best


def _smeared(mask: int, slack: int) -> int:
    """Bits of mask, each repeated at the next ``slack`` places."""
    done = 0
    while done < slack:
        more = min(done + 1, slack - done)
        mask |= mask << more
        done += more
    return mask


def dominated(filling: list[int], waste: int, left: dict[int, int]) -> bool:
    """Whether some lengths of a filling (without its largest) could give way to one length
    left over that is as large as they together, or larger by no more than the waste."""
    one = several = 0
    for size in filling:
        several |= (several | one) << size
        one |= 1 << size
    spare = sum(1 << size for size, n in left.items() if n)
    if _smeared(several, waste) & spare:
        return True
    return bool(waste and _smeared(one << 1, waste - 1) & spare)


def undominated_fillings(lengths: list[int], left: dict[int, int], room: int, most_waste: int, tick) -> Iterator[tuple[int, list[int]]]:
    """(waste, lengths) of every undominated filling of ``room`` that wastes at most so much.

    Depth first, the greatest length that fits and as many of it as fit; lengths go down along
    a branch. ``tick`` is called once a step and ends the enumeration when it returns false.
    """
    below = list(itertools.accumulate(size * left[size] for size in lengths))
    # (room, place of the next length to decide, chosen so far)
    stack = [(room, len(lengths) - 1, ())]
    while stack:
        room, i, chosen = stack.pop()
        if not tick():
            return
        i = min(i, bisect.bisect_right(lengths, room) - 1)
        if i < 0 or room == 0:
            rest = left | {size: left[size] - n for size, n in chosen}
            filling = [size for size, n in chosen for _ in range(n)]
            if room <= most_waste and not dominated(filling, room, rest):
                yield room, filling
            continue
        if room - below[i] > most_waste:
            continue
        size = lengths[i]
        for many in range(min(left[size], room // size) + 1):  # the last pushed is tried first
            stack.append((room - many * size, i - 1, (*chosen, (size, many)) if many else chosen))


def _greedy(counts: dict[int, int], capacity: int) -> Plan:
    """Fillings one after another, each the one that wastes least around the largest length."""
    left = {size: n for size, n in counts.items() if n}
    lengths = sorted(left)
    plan = []
    while lengths:
        top = lengths[-1]
        left[top] -= 1
        rest = complete_bin(lengths, left, capacity - top)
        left[top] += 1
        filling = [top, *rest]
        times = min(left[size] // filling.count(size) for size in set(filling))
        plan.append((filling, times))
        for size in filling:
            left[size] -= times
        lengths = [size for size in lengths if left[size]]
    return plan


#: Steps of the search over sequences; None searches until the plan is optimal.
STEPS = 10_000
#: Fillings that are sorted by waste at once.
_AHEAD = 64


def plan_fillings(counts: dict[int, int], capacity: int = CAPACITY, steps: int | None = STEPS) -> Plan:
    """Fillings (lengths, the largest first) and how often each is used; uses up all counts.

    Never more sequences than best-fit decreasing. The least possible number where the search
    ends by itself, as it always does with ``steps=None``; then the time has no bound.
    """
    counts = {size: n for size, n in counts.items() if n}
    best = min(best_fit_decreasing(counts, capacity), _greedy(counts, capacity), key=sequences_of)
    least = lower_bound(counts, capacity)
    taken = 0

    def tick() -> bool:
        nonlocal taken
        taken += 1
        return steps is None or taken <= steps

    def children(left: dict[int, int], used: int) -> Iterator[tuple[list[int], int]]:
        """What can come next: a filling around the largest length, and how often."""
        lengths = [size for size in sorted(left) if left[size]]
        top = lengths[-1]
        total = sum(size * left[size] for size in lengths)
        without = left | {top: left[top] - 1}
        lengths = [size for size in lengths if without[size]]

        def spendable() -> int:  # an improvement has one sequence less than the incumbent
            return (sequences_of(best) - 1 - used) * capacity - total

        found = undominated_fillings(lengths, without, capacity - top, spendable(), tick)
        while ahead := sorted(itertools.islice(found, _AHEAD)):
            for waste, rest in ahead:
                filling = [top, *rest]
                most = min(left[size] // filling.count(size) for size in set(filling))
                for times in range(most, 0, -1):
                    if not tick():
                        return
                    if waste * times <= spendable():
                        yield filling, times

    # one level per filling: what is left, sequences used, the plan so far, its children
    path: list[tuple[list[int], int]] = []
    levels = [(counts, 0, children(counts, 0))] if counts and sequences_of(best) > least else []
    while levels:
        left, used, going = levels[-1]
        step = next(going, None)
        if step is None or sequences_of(best) == least:
            levels.pop()
            if path:
                path.pop()
            continue
        filling, times = step
        rest = dict(left)
        for size in filling:
            rest[size] -= times
        rest = {size: n for size, n in rest.items() if n}
        used += times
        path.append((filling, times))
        if not rest:
            if used < sequences_of(best):
                best = list(path)
            path.pop()
        elif used + lower_bound(rest, capacity) < sequences_of(best):
            levels.append((rest, used, children(rest, used)))
        else:
            path.pop()
    return best


def pack(pieces: DataFrame, capacity: int = CAPACITY, steps: int | None = STEPS) -> DataFrame:
    """pieces (doc_id, piece, length, ...) with sequence_id and offset, in few sequences.

    Lengths lie between 1 and the capacity. Repeated pieces each get a place. The driver sees
    one count per length, and its plan has at most as many fillings as those allow; both are
    bounded by the capacity, not by the corpus.
    """
    spark = pieces.sparkSession
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    rows, used, first = [], dict.fromkeys(counts, 0), 0
    for filling, times in plan_fillings(counts, capacity, steps):
        offset = 0
        for size in dict.fromkeys(filling):
            many = filling.count(size)
            rows.append((size, used[size], used[size] + many * times, many, first, offset))
            used[size] += many * times
            offset += many * size
        first += times
    # the places of a length are disjoint ranges of rank. Ranks are cut in blocks, twice as many
    # as the length has ranges, so that a piece meets the few ranges of its block alone
    of_length = Counter(r[0] for r in rows)
    step = {size: max(1, n // (2 * of_length[size])) for size, n in counts.items()}
    blocks = [(*r, block) for r in rows for block in range(r[1] // step[r[0]], (r[2] - 1) // step[r[0]] + 1)]
    ranges = spark.createDataFrame(blocks, "_size long, _from long, _to long, _many long, _first long, _offset long, _block long")
    steps = spark.createDataFrame(list(step.items()), "_length long, _step long")
    parts = max(16, partitions(spark))
    ranked = numbered(pieces, "length", [F.col("doc_id"), F.col("piece"), F.col("ids_crc32")], F.struct("doc_id", "piece"), parts, "_nth")
    ranked = ranked.join(F.broadcast(steps), F.col("length") == F.col("_length"))
    here = (F.col("length") == F.col("_size")) & (F.floor(F.col("_nth") / F.col("_step")) == F.col("_block"))
    placed = ranked.join(F.broadcast(ranges), here & (F.col("_nth") >= F.col("_from")) & (F.col("_nth") < F.col("_to")))
    turn = F.col("_nth") - F.col("_from")
    return placed.select(
        *(F.col(c) for c in pieces.columns),
        (F.col("_first") + F.floor(turn / F.col("_many"))).cast("long").alias("sequence_id"),
        (F.col("_offset") + (turn % F.col("_many")) * F.col("length")).cast("long").alias("offset"),
    )


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, steps: int | None = STEPS) -> DataFrame:
    """Every document's pieces in sequences of at most ``capacity`` tokens.

    Result: doc_id, piece, start, length, ids_crc32, sequence_id, offset. A null or empty text
    is its end id alone. Rows equal in doc_id and text are packed each. An empty table gives
    an empty result; columns other than doc_id and text are ignored. Pieces, a few numbers
    each, are written to the shared folder, so that texts are encoded once.
    """
    return pack(written(pieces_of(docs, path, capacity), "pieces"), capacity, steps)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op8_bin_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, in sequences of 4096."""
    return pack_documents(table(spark, sf_dir, "documents"), default_tokenizer())
