import random
from collections import defaultdict

import pytest

from txnmill.llm.packing import Packer, best_packing, cost, pack


def check(rows, lengths):
    bins = defaultdict(list)
    for r in rows:
        if r.length:
            bins[r.bin_id].append(r)
        else:
            assert r.bin_id is None and r.bin_offset is None
    for content in bins.values():
        content.sort(key=lambda r: r.bin_offset)
        at = 0
        for r in content:
            assert r.bin_offset == at
            at += r.length
        assert {r.bin_length for r in content} == {min(c for c in lengths if c >= at)}
    return bins


def test_best_fit_takes_the_least_room():
    packer = Packer(10_000, [10], price=lambda c: c)
    assert [packer.add(n) for n in (8, 7, 6)] == [(0, 0), (1, 0), (2, 0)]
    assert packer.add(2) == (0, 8)
    assert packer.add(3) == (1, 7)
    assert packer.add(3) == (2, 6)
    assert packer.add(1) == (2, 9)
    assert packer.final_sizes().tolist() == [10, 10, 10]


def test_lengths_are_chosen_by_cost_and_what_is_left():
    packer = Packer(5000, [512, 1024, 2048, 4096])
    packer.add(300)
    assert packer.size == [1024]  # the least cost per token while there is enough to fill it
    last = Packer(300, [512, 1024, 2048, 4096])
    last.add(300)
    assert last.size == [512]
    assert cost(1024) / 1024 < min(cost(512) / 512, cost(2048) / 2048)


def paid(sizes, price):
    return sum(price(int(c)) for c in sizes)


def least(pieces, lengths, price):
    """Least cost of any packing, by the best first bin of every set of pieces."""
    n, every = len(pieces), (1 << len(pieces)) - 1
    weight = [0] * (every + 1)
    bins = [float("inf")] * (every + 1)
    for mask in range(1, every + 1):
        low = (mask & -mask).bit_length() - 1
        weight[mask] = weight[mask & (mask - 1)] + pieces[low]
        bins[mask] = min((price(c) for c in lengths if c >= weight[mask]), default=float("inf"))
    best = [0.0] * (every + 1)
    for mask in range(1, every + 1):
        low, rest = mask & -mask, mask & (mask - 1)
        best[mask], some = float("inf"), rest
        while True:
            best[mask] = min(best[mask], bins[some | low] + best[mask ^ some ^ low])
            if not some:
                break
            some = (some - 1) & rest
    return best[every] if n else 0.0


def test_cost_is_near_that_of_an_exact_search():
    rng = random.Random(6)
    lengths, ratios, alone = (8, 16, 32, 64), [], []

    def price(c):
        return 4 + c + c * c / 128

    for case in range(60):
        top = rng.choice([10, 30, 64])
        pieces = sorted((rng.randint(1, top) for _ in range(rng.randint(1, 10 if case else 12))), reverse=True)
        placed, sizes = best_packing(pieces, lengths, price)
        held = [0] * len(sizes)
        for (at, offset), n in zip(placed.tolist(), pieces, strict=True):
            assert offset == held[at]
            held[at] += n
        assert [min(c for c in lengths if c >= h) for h in held] == sizes.tolist()
        exact = least(pieces, lengths, price)
        ratios.append(paid(sizes, price) / exact)
        packer = Packer(sum(pieces), lengths, price)
        for n in pieces:
            packer.add(n)
        alone.append(paid(packer.final_sizes(), price) / exact)
        assert 1 - 1e-9 <= ratios[-1] <= min(1.25, alone[-1] + 1e-9)
    assert sum(ratios) / len(ratios) < 1.04 < sum(alone) / len(alone) + 0.04


def test_a_length_that_pieces_fit_beats_one_that_is_cheap_by_itself():
    """Pieces of 500 fill 512, two of them leave 24 of 1024, which costs least a token."""
    placed, sizes = best_packing([500] * 7, (512, 1024))
    assert sorted(sizes.tolist()) == [512] + [1024] * 3
    placed, sizes = best_packing([700] * 6, (768, 1024, 2048))
    assert sizes.tolist() == [768] * 6


@pytest.mark.parametrize("part_tokens", [10**6, 2000])
def test_every_piece_once(documents, part_tokens):
    rng = random.Random(2)
    words = {i: int(rng.expovariate(1 / 60)) for i in range(400)} | {999: 1000, 998: 64, 997: 65}
    rows = pack(documents(*((i, "w " * n) for i, n in words.items())), lengths=(8, 32, 64), part_tokens=part_tokens).collect()
    bins = check(rows, (8, 32, 64))
    pieces = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append((r.piece, r.start, r.length))
    for i, n in words.items():
        want = [(k, 64 * k, min(64, n - 64 * k)) for k in range(max(1, -(-n // 64)))]
        assert sorted(pieces[i]) == want
    room = sum(b[0].bin_length for b in bins.values())
    assert sum(words.values()) >= 0.9 * room


def test_odd_rows(odd, none):
    rows = pack(odd).collect()
    check(rows, (512, 1024, 2048, 4096))
    assert sum(r.length for r in rows) == sum(len((r.text or "").split()) for r in odd.collect())
    assert len({r.row_no for r in rows}) == odd.count()
    assert pack(none).count() == 0
