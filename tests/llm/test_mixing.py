from collections import Counter

import pytest

from farelane.llm import mixing
from tests.llm import frames


def test_cycle_stays_within_one_block():
    for blocks in ({0: 1, 1: 1}, {0: 500, 1: 300, 2: 200}, {0: 1, 1: 998, 2: 1}, dict(enumerate([7, 13, 1, 1, 28, 50]))):
        cycle = [s for s, _ in mixing.dealt(blocks, blocks)]  # all sources end together
        length, got = sum(blocks.values()), Counter()
        assert Counter(cycle) == blocks
        for t, s in enumerate(cycle, 1):
            got[s] += 1
            assert all(abs(got[x] * length - m * t) < length for x, m in blocks.items())


def _check(rows, weights, names, block_rows):
    """Slots are dealt once each, blocks in order, less than a block off in every phase."""
    slots = {}
    for r in rows:
        assert slots.setdefault(r["slot"], (r["source"], r["block"])) == (r["source"], r["block"])
        assert r["mix_position"] == r["slot"] * block_rows + r["block_row"]
    assert sorted(slots) == list(range(len(slots)))
    assert len({r["mix_position"] for r in rows}) == len(rows)
    n = Counter(r["source"] for r in rows)
    for s, c in n.items():
        mine = [slots[t][1] for t in sorted(slots) if slots[t][0] == s]
        assert mine == list(range(-(-c // block_rows)))
    first_phase = [t for t in sorted(slots) if next(r["phase"] for r in rows if r["slot"] == t) == 0]
    got, total = Counter(), sum(weights.values())
    for t in first_phase[:-1]:  # all sources last until here
        got[slots[t][0]] += 1
        assert all(abs(got[names[i]] - (t + 1) * w / total) < 1 + 1e-6 for i, w in weights.items())


def test_hot_source_and_targets(spark):
    rows = [(i, f"t{i}", "hot" if i % 3 == 0 else f"s{i % 5}") for i in range(900)] + [(1000 + i, None, None) for i in range(7)]
    df = frames.docs(spark, rows)
    weights = {"hot": 0.5, "s0": 0.1, "s1": 0.1, "s2": 0.1, "s3": 0.1, "s4": 0.05, None: 0.05}
    got = mixing.mix(df, weights=weights, block_rows=2, rows_per_cell=40).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(r[0] for r in rows)
    names = sorted((k for k in weights if k), key=str) + [None]
    _check(got, {i: weights[s] for i, s in enumerate(names)}, names, 2)


def test_rows_alike_odd_rows_and_clashes(spark):
    df = frames.with_clashes(frames.docs(spark, frames.odd_rows() + [(5, "same", "s1")] * 50))
    out = mixing.mix(df, block_rows=4)
    assert out.columns[:len(df.columns)] == df.columns and out.count() == len(frames.odd_rows()) + 50
    assert len({r["mix_position_"] for r in out.collect()}) == out.count()
    ordered = mixing.in_mix_order(df, block_rows=4)
    assert ordered.columns == df.columns
    key = lambda r: (str(r["doc_id"]), str(r["text"])[:40])
    assert [key(r) for r in ordered.collect()] == [key(r) for r in sorted(out.collect(), key=lambda r: r["mix_position_"])]


def test_errors_and_empty(spark):
    df = frames.docs(spark, [(1, "a", "x"), (2, "b", "y")])
    with pytest.raises(ValueError):
        mixing.mix(df, weights={"x": 1.0})
    with pytest.raises(ValueError):
        mixing.mix(df, max_sources=1)
    assert mixing.mix(frames.docs(spark, [])).count() == 0


def _deviation(blocks, weights):
    """The largest distance, in blocks, of any source from its exact share at
    any slot: in each phase the sources that last deal by their weights."""
    ideal, gone, at = dict.fromkeys(blocks, 0.0), set(), 0.0
    got, worst = Counter(), 0.0
    for t, (s, _) in enumerate(mixing.dealt(blocks, weights), 1):
        got[s] += 1
        while at < t - 1e-9:
            last = [x for x in blocks if x not in gone]
            rate = sum(weights[x] for x in last)
            first = min(last, key=lambda x: (blocks[x] - ideal[x]) / weights[x])
            step = min(t - at, (blocks[first] - ideal[first]) / weights[first] * rate)
            for x in last:
                ideal[x] += step * weights[x] / rate
            at += step
            gone |= {x for x in last if blocks[x] - ideal[x] < 1e-7}
        worst = max(worst, max(abs(got[x] - ideal[x]) for x in blocks))
    assert got == Counter(blocks)
    return worst


def test_sources_shorter_than_a_cycle_keep_the_weights(spark):
    blocks = {0: 230} | {i: 25 for i in range(1, 20)}
    weights = {s: n ** 0.5 for s, n in blocks.items()}
    assert _deviation(blocks, weights) < 1 + 1e-6
    for case in ({0: 1, 1: 70, 2: 9, 3: 9, 4: 33}, {0: 400, 1: 3, 2: 1, 3: 1}):
        for w in ({s: n ** 0.5 for s, n in case.items()}, {s: 1.0 + s / 7 for s in case}):
            assert _deviation(case, w) < 1 + 1e-6
    rows = [(i, "t", "hot" if i % 3 == 0 else f"s{i % 4}") for i in range(1200)]
    got = mixing.mix(frames.docs(spark, rows), block_rows=4).collect()
    dealt = {r["slot"]: r["source"] for r in got}
    n = {s: -(-c // 4) for s, c in Counter(r["source"] for r in got).items()}
    w = {s: c ** 0.5 for s, c in Counter(r["source"] for r in got).items()}
    names, first = sorted(n), max(r["slot"] for r in got if r["phase"] == 0)
    assert [names[s] for s, _ in mixing.dealt({i: n[s] for i, s in enumerate(names)}, {i: w[s] for i, s in enumerate(names)})] == [dealt[t] for t in range(len(dealt))]
    for t in range(1, first + 1):
        hot = sum(dealt[x] == "hot" for x in range(t))
        assert abs(hot - t * w["hot"] / sum(w.values())) < 1 + 1e-6


def test_exact_weights_over_many_cycles():
    # equal sources whose share is no whole number of 1000 slots, and one far under a slot
    blocks = {0: 20_000} | {i: 2100 for i in range(1, 20)} | {20: 5}
    weights = {s: n ** 0.5 for s, n in blocks.items()} | {20: 0.01}
    slots = list(mixing.dealt(blocks, weights))
    assert Counter(s for s, _ in slots) == Counter(blocks)
    total, got = sum(weights.values()), Counter()
    first = mixing.Ideal(blocks, weights).starts()[1]
    assert first > 40_000
    for t, (s, _) in enumerate(slots, 1):
        if t >= first:  # all sources last until here
            break
        got[s] += 1
        assert all(abs(got[x] - t * w / total) < 1 + 1e-6 for x, w in weights.items())


def test_any_number_of_sources(spark, monkeypatch):
    rows = [(i, f"t{i}", "hot" if i < 300 else f"s{i % 450}") for i in range(1000)]
    df = frames.docs(spark, rows)
    small = mixing.mix(df, block_rows=4).collect()
    n = Counter(r[2] for r in rows)
    _check(small, {i: n[s] ** 0.5 for i, s in enumerate(sorted(n))}, sorted(n), 4)
    assert sorted(r["doc_id"] for r in small) == list(range(1000)) and len(n) > 400
    # without broadcasts, the schedule in parts
    monkeypatch.setattr(mixing, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(mixing, "SLOTS", 150)
    assert sorted(mixing.mix(df, block_rows=4).collect(), key=str) == sorted(small, key=str)
