"""Very long texts: bounded layout, the same scores as in one piece."""

import tracemalloc

import numpy as np
import pytest

from lunario.llm import recurrent


def test_a_text_of_300_000_tokens_takes_no_room_in_other_lanes():
    draw = np.random.default_rng(1)
    model = recurrent.Recurrent(64)
    texts = [draw.integers(0, 65, n).astype(np.int32) for n in [300_000] + [50] * 1000]
    tracemalloc.start()
    found = recurrent.score(model, texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # All lanes over all steps would be 300,000 x 256 cells of 14 bytes, over a GB.
    assert peak < 100e6
    assert found[0] == pytest.approx(recurrent.score(model, texts[:1])[0], rel=1e-5)
    assert found[1] == pytest.approx(recurrent.score(model, texts[1:2])[0], rel=1e-5)


@pytest.mark.parametrize("width", [1, 2, 7])
def test_stretches_join_to_the_whole_layout(width, monkeypatch):
    draw = np.random.default_rng(2)
    texts = [draw.integers(0, 65, n).astype(np.int32) for n in (90, 1, 33, 64, 2, 17, 90)]
    whole = recurrent.lanes(texts, 64, width)
    monkeypatch.setattr(recurrent, "STRETCH", 32)
    at = 0
    for window in recurrent.Lanes(texts, 64, width).windows(16):
        for part, all_of_it in zip(window, whole):
            k = part.shape[1]
            assert (part == all_of_it[at : at + len(part), :k]).all()
            assert not whole[3][at : at + len(part), k:].any()
        at += len(window[0])
    assert at == len(whole[0])


def test_windows_hold_more_steps_where_few_lanes_run():
    draw = np.random.default_rng(3)
    texts = [draw.integers(0, 65, n).astype(np.int32) for n in [5000] + [40] * 600]
    laid = recurrent.Lanes(texts, 64)
    cells = [[part[mask] for part in (target, previous)] for target, previous, _, mask, _ in laid.windows(16, longest=recurrent.LONGEST)]
    # Every id is a target once, after the id before it, whatever the windows are.
    plain = [[part[mask] for part in (target, previous)] for target, previous, _, mask, _ in laid.windows(16)]
    for k in range(2):
        assert (np.concatenate([c[k] for c in cells]) == np.concatenate([c[k] for c in plain])).all()
    assert sum(len(c[0]) for c in cells) == sum(map(len, texts))
    # One long text does not cost a scoring window for every 64 of its words.
    model, calls = recurrent.Recurrent(64), []
    steps = model.steps
    model.steps = lambda *a, **k: calls.append(1) or steps(*a, **k)
    recurrent.score(model, texts)
    assert len(calls) < 5000 / 64 / 4


def test_gradients_by_steps_equal_those_of_the_window():
    draw = np.random.default_rng(6)
    model, H = recurrent.Recurrent(64), recurrent.HIDDEN
    texts = [np.append(draw.integers(1, 65, n), 0).astype(np.int32) for n in draw.integers(1, 9, 40)]
    target, previous, first, mask, _ = recurrent.lanes(texts, 64, 6)
    h = np.zeros((target.shape[1], H), np.float32)
    grads, _, last = model.gradients(previous, first, target, mask, h)
    kept, live = model.steps(previous, first, h), np.flatnonzero(mask.ravel())
    fresh = {name: np.zeros_like(v) for name, v in model.p.items()}
    dh_out = np.zeros((mask.size, H), np.float32)
    dh_out[live] = model.output(kept["out"][live], target.ravel()[live], fresh)[1]
    dh_out, dh, state = dh_out.reshape(*mask.shape, H), np.zeros_like(h), np.zeros_like(model.p["state"])
    inputs = np.zeros(model.p["inputs"].shape)
    for t in range(len(mask) - 1, -1, -1):
        dh = dh + dh_out[t]
        h0, z, r, n, u = (kept[k][t] for k in ("h", "z", "r", "n", "u"))
        dn = dh * (1 - z) * (1 - n * n)
        to_z, to_r = dh * (h0 - n) * z * (1 - z), dn * u * r * (1 - r)
        dg = np.hstack([to_z, to_r, dn * r])
        np.add.at(inputs, previous[t], np.hstack([to_z, to_r, dn]))
        state += h0.T @ dg
        dh = np.where(first[t][:, None], np.float32(0), dh * z + dg @ model.p["state"].T)
    assert grads["state"] == pytest.approx(state, rel=1e-5, abs=1e-5)
    assert grads["inputs"] == pytest.approx(inputs, rel=1e-4, abs=1e-5)
    assert (last == kept["last"]).all()


def test_ordinary_words_go_through_the_tree(monkeypatch):
    import random

    import public_tokenizers
    import tiktoken

    from lunario.llm import byte_bpe

    coder = byte_bpe.ByteBPE.from_file(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.ranks, special_tokens={})
    joins, join = [], coder.join
    monkeypatch.setattr(coder, "join", lambda left, right: joins.append((left, right)) or join(left, right))
    rng = random.Random(3)
    parts = "anti constitution tion al ly thed inthe bleness Éclat über straße 数字 ing".split()
    words = ["".join(rng.choices(parts, k=rng.randint(1, 5))) for _ in range(3000)]
    text = " ".join(words) + "\n" + "ab" * 700 + " " * 90
    assert coder.encode(text) == own.encode_ordinary(text)
    # Many words are longer than a leaf; some seams are stable at once, others are merged anew.
    assert len(joins) > 1000
    stable = sum(bool(a and b) and coder.stable(a[-1], b[0]) for a, b in joins)
    assert 50 < stable < len(joins) - 50
    for a, b in joins[:500]:
        data = coder.decode(a + b)
        assert join(a, b) == coder.merge(data)
