"""Inputs at the edges of the operators' methods, which must be done in full."""

import numpy as np

from noticeworks.llm import pieces, syncmers


def test_every_text_has_an_anchor_and_only_equal_short_ones_are_alike():
    rng = np.random.default_rng(7)
    for n in range(1, 61):
        texts = {"".join(map(chr, rng.integers(97, 123, n) if n > 1 else [97 + i])) for i in range(40 if n > 1 else 26)}
        sketches = {t: syncmers.sketch(t) for t in texts}
        assert all(len(s) for s in sketches.values())
        first, *others = sketches
        assert all(syncmers.likeness(sketches[first], sketches[t], 128) < 1.0 for t in others)
        assert syncmers.likeness(sketches[first], syncmers.sketch(""), 128) == 0.0
    empty = syncmers.sketch("")
    assert not len(empty) and syncmers.likeness(empty, empty, 128) == 1.0


def log_weights(text, v, power=1.0, offset=10.0):
    """Logarithm of the weight of all segmentations, and a function for that of one."""
    base = v.bytes_from + 256
    n = len(v.pieces) - base
    ids = {v.pieces[i]: i for i in range(base, len(v.pieces))}
    of = lambda i: -power * np.log((i - base + 1 if i >= 0 else n) + offset)
    total = np.full(len(text) + 1, -np.inf)
    total[-1] = 0.0
    for a in range(len(text) - 1, -1, -1):
        ways = [of(ids[text[a:b]]) + total[b] for b in range(a + 1, min(len(text), a + v.longest) + 1) if text[a:b] in ids]
        if text[a] not in ids:
            ways.append(of(-1) + total[a + 1])
        total[a] = np.logaddexp.reduce(ways)
    return total[0], lambda path: sum(of(int(i)) for i in path)


def test_words_of_any_length_are_segmented_whole():
    v = pieces.vocabulary(pieces.default_model(), 1.0, 10.0)
    rng = np.random.default_rng(3)
    texts = [
        " " * 5000 + "x", " " * 5000, "\n" + " " * 300 + "\n", "天地玄黄宇宙洪荒日月" * 30, "𠀀" * 300, "https://example.org/" + "segmentation/" * 20, "the" * 40,
        "  " + "".join(map(chr, rng.integers(97, 123, 64))), "".join(map(chr, rng.integers(48, 123, 3000))),
    ]
    for text, rows in zip(texts, pieces.sample_block(texts, list(range(len(texts))), v, pieces.Sampling()), strict=True):
        whole, weight = log_weights("▁" + text.replace(" ", "▁"), v)
        assert rows and len({tuple(r[0]) for r in rows}) == len(rows)
        for ids, log_p, *_ in rows:
            assert abs(log_p - (weight(ids) - whole)) < 1e-6
            assert pieces.decode(pieces.spell(ids, v), v) == text
    # more than one text of a kind in a block, and a text alone: the same paths
    both = pieces.sample_block(texts, list(range(len(texts))), v, pieces.Sampling())
    for i in (0, 3, 8):
        alone = pieces.sample_block([texts[i]], [i], v, pieces.Sampling())[0]
        assert [list(r[0]) for r in alone] == [list(r[0]) for r in both[i]]


def test_pieces_cross_the_64th_letter():
    v = pieces.vocabulary(pieces.default_model(), 1.0, 10.0)
    text = "the" * 40
    crossed = 0
    for rows in pieces.sample_block([text] * 200, list(range(200)), v, pieces.Sampling()):
        ends = np.cumsum([len(v.pieces[i]) if i >= 0 else 1 for i in rows[0][0]])
        crossed += 65 not in ends
    assert crossed > 20
