"""Order min-hash against its definition: bins, occurrence numbers, text order and tuples, one k-mer at a time."""

import numpy as np
import pytest

from voxtile.llm import order_minhash as om
from voxtile.llm.common import mix, windows

M64 = 2**64 - 1
GOLD = 0x9E3779B97F4A7C15


def scramble(x: int) -> int:
    return int(mix(np.array([x & M64], np.uint64))[0])


def plain(text: str, k: int, size: int, bins: int) -> list[int]:
    out = [0] * bins
    if not text:
        return out
    points = [ord(c) for c in text]
    points += [0] * (k - len(points))
    seen: dict[int, int] = {}
    in_bin: dict[int, list[tuple[int, int, int]]] = {}
    for at in range(len(points) - k + 1):
        gram = int(windows(np.array(points[at : at + k], np.uint64), k)[0])
        nth = seen.get(gram, 0)
        seen[gram] = nth + 1
        h = scramble(gram + nth * GOLD)
        bits = (bins - 1).bit_length()
        in_bin.setdefault(h >> (64 - bits) if bits else 0, []).append((h >> 36, at, gram))  # 28 bits decide, then the place
    for b, grams in in_bin.items():
        chosen = sorted(sorted(grams)[:size], key=lambda g: g[1])  # the smallest, back in the order of the text
        total = sum(scramble(gram + (i + 1) * GOLD) for i, (_, _, gram) in enumerate(chosen)) & M64
        out[b] = max(scramble(total) >> 48, 1)
    return out


def texts():
    rng = np.random.default_rng(31)
    make = lambda letters, n: "".join(rng.choice(list(letters), n))
    return ["", "a", "abcdefg", "abcdefgh", "abcdefghi", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "é😀" * 20, make("ab", 300), make("abcdefghij klm", 900), make("xy", 60) * 9, " \n\t " * 9]


@pytest.mark.parametrize("k, size, bins", [(8, 2, 64), (3, 3, 16), (5, 1, 32), (1, 2, 64)])
def test_against_the_definition(k, size, bins):
    every = texts()
    got = om.signatures([*every, None], k, size, bins)
    assert [row.tolist() for row in got] == [plain(t, k, size, bins) for t in [*every, ""]]
    one = [om.signatures([t], k, size, bins)[0].tolist() for t in every]
    assert one == [row.tolist() for row in got[:-1]]  # whatever texts stand beside


def test_it_tells_order_and_edits():
    """Moved blocks keep the k-mers but not their order; likeness falls with the number of edits."""
    rng = np.random.default_rng(32)
    base = "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz "), 4000))
    same = lambda x: float((om.signatures([base, x])[0] == om.signatures([base, x])[1]).mean())

    def edited(n):
        x = list(base)
        for i in rng.choice(len(x), n, replace=False):
            x[i] = "#"
        return "".join(x)

    few, more, many = (np.mean([same(edited(n)) for _ in range(5)]) for n in (10, 60, 300))
    assert 1 > few > more > many
    blocks = [base[i : i + 400] for i in range(0, 4000, 400)]
    assert same("".join(reversed(blocks))) < 0.75  # nearly all k-mers are there still


def test_kmers_that_share_half_a_hash_are_put_apart_alone(monkeypatch):
    """Equal to a whole sort by (text, hash, place); only runs with different k-mers are sorted again."""
    rng = np.random.default_rng(3)
    doc = np.repeat(np.arange(40), 50)
    gram = rng.integers(0, 30, 2000).astype(np.uint64) << np.uint64(32) | (rng.random(2000) < 0.1).astype(np.uint64) * rng.integers(1, 3, 2000).astype(np.uint64)
    by = np.lexsort((np.arange(2000), gram >> np.uint64(32), doc))
    want = np.lexsort((np.arange(2000), gram, doc))
    sizes, plain = [], np.lexsort
    monkeypatch.setattr(om.np, "lexsort", lambda keys: sizes.append(len(keys[0])) or plain(keys))
    assert (om._settled(by, doc, gram) == want).all()
    assert sizes and max(sizes) < 2000
