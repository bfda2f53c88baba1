"""Gated recurrent language model in numpy, with a class-factored softmax.

Ids: 0 is the end of a text, 1 to ``size - 1`` are the known words, ``size`` is
any rarer word, ``size + 1`` the start. Known ids form classes of ``WIDTH``; a
rarer word is a class of its own, whose words the caller weighs by counts.
Texts run in parallel lanes; a lane that ends a text starts the next with a
fresh state, and the state is carried across windows, so the log-likelihood is
that of whole texts. Gradients are cut at window starts.
"""

from __future__ import annotations

import heapq

import numpy as np

HIDDEN = 16
WIDTH = 32
LANES = 256
#: Steps that gradients go back; scores do not depend on the window.
WINDOW = 16
SCORE_WINDOW = 64
#: Times as many steps that a scoring window takes at most where few lanes still run, so that it holds as many cells.
LONGEST = 16
#: Steps whose cells are laid out at once, about.
STRETCH = 1024
RATE = 0.12
#: Logits up to this size need no shift in single precision.
LARGEST = 60.0


class Recurrent:
    """Parameters by name, all float32; ``size`` known ids, a multiple of ``WIDTH``."""

    def __init__(self, size: int, seed: int = 7):
        self.size, self.classes = size, size // WIDTH + 1
        draw = np.random.default_rng(seed)

        def normal(*shape: int, scale: float) -> np.ndarray:
            return (draw.standard_normal(shape) * scale).astype(np.float32)

        self.p = {
            "inputs": normal(size + 2, 3 * HIDDEN, scale=0.3),
            "state": normal(HIDDEN, 3 * HIDDEN, scale=HIDDEN**-0.5),
            "class_w": normal(HIDDEN, self.classes, scale=0.1),
            "class_b": np.zeros(self.classes, np.float32),
            "word_w": normal(self.classes - 1, HIDDEN, WIDTH, scale=0.1),
            "word_b": np.zeros((self.classes - 1, WIDTH), np.float32),
        }

    def set_biases(self, counts: np.ndarray, rare: float) -> None:
        """Starts the output at the frequencies of the known ids and of all rarer words."""
        some = counts.astype(np.float64) + 1.0
        by_class = some.reshape(-1, WIDTH)
        self.p["word_b"][:] = np.log(by_class / by_class.sum(axis=1, keepdims=True))
        shares = np.append(by_class.sum(axis=1), rare + 1.0)
        self.p["class_b"][:] = np.log(shares / shares.sum())

    def flat(self) -> np.ndarray:
        return np.concatenate([v.ravel() for v in self.p.values()])

    def load(self, values: np.ndarray) -> None:
        at = 0
        for name, old in self.p.items():
            self.p[name] = values[at : at + old.size].reshape(old.shape).astype(np.float32)
            at += old.size

    def steps(self, previous: np.ndarray, first: np.ndarray, h: np.ndarray, keep: bool = True) -> dict:
        """Runs the gates over a window; arrays are (time, lane), ``h`` the state carried in.

        With ``keep`` also what the gradients need: h, z, r, n, u by step.
        """
        H, (T, L) = HIDDEN, previous.shape
        x, state = self.p["inputs"][previous], self.p["state"].copy()
        # Both gates need the negative of their sums.
        for part in (x, state):
            np.negative(part[..., : 2 * H], out=part[..., : 2 * H])
        out = np.empty((T, L, H), state.dtype)
        rows = T if keep else min(T, 1)
        g, gates, n = (np.empty((rows, L, width * H), state.dtype) for width in (3, 2, 1))
        fresh, begin = first.any(axis=1).tolist(), h
        views = g, g[..., : 2 * H], g[..., 2 * H :], gates, gates[..., :H], gates[..., H:], n
        views = list(zip(*views)) if keep else list(zip(*views)) * T
        for t, (x_gates, x_n, to) in enumerate(zip(x[..., : 2 * H], x[..., 2 * H :], out)):
            if fresh[t]:
                h = np.where(first[t][:, None], np.float32(0), h)
            sums, g_gates, u, both, z, r, new = views[t]
            np.matmul(h, state, out=sums)
            np.add(x_gates, g_gates, out=both)
            np.exp(both, out=both)
            np.add(both, 1, out=both)
            np.reciprocal(both, out=both)
            np.multiply(r, u, out=new)
            np.add(new, x_n, out=new)
            np.tanh(new, out=new)
            np.subtract(h, new, out=to)
            np.multiply(to, z, out=to)
            h = np.add(to, new, out=to)
        kept = {"out": out.reshape(-1, H), "last": h}
        if keep:
            before = np.concatenate([begin[None], out[:-1]])
            before[first] = 0
            kept |= {"h": before, "z": gates[..., :H], "r": gates[..., H:], "n": n, "u": g[..., 2 * H :]}
        return kept

    def _within_range(self) -> bool:
        """Whether no state, which lies between -1 and 1, gives a logit that ``exp`` could not hold."""
        p = self.p
        classes = np.abs(p["class_w"]).sum(axis=0) + np.abs(p["class_b"])
        words = np.abs(p["word_w"]).sum(axis=1) + np.abs(p["word_b"])
        return max(classes.max(), words.max()) < LARGEST

    def output(self, h: np.ndarray, target: np.ndarray, grads: dict | None = None):
        """Natural log probability of each target; with ``grads`` also adds to them, and dh."""
        p, rows = self.p, np.arange(len(target))
        # Shifting logits by their largest changes nothing but their range.
        shift = not self._within_range()
        of = np.minimum(target, self.size) // WIDTH
        logits = h @ p["class_w"] + p["class_b"]
        if shift:
            logits -= logits.max(axis=1, keepdims=True)
        e = np.exp(logits)
        total = e @ np.ones(self.classes, e.dtype)
        found = (logits[rows, of] - np.log(total)).astype(np.float64)
        dh = None
        if grads is not None:
            e /= -total[:, None]
            e[rows, of] += 1
            grads["class_w"] += h.T @ e
            grads["class_b"] += np.ones(len(e), e.dtype) @ e
            dh = e @ p["class_w"].T
        order = np.argsort(of, kind="stable")
        cuts = np.searchsorted(of[order], np.arange(self.classes)).tolist()
        hs_all, inside_all, wide = h[order], (target - of * WIDTH)[order], np.ones(WIDTH, e.dtype)
        for c in range(self.classes - 1):
            begin, end = cuts[c], cuts[c + 1]
            if begin == end:
                continue
            hs, one = hs_all[begin:end], rows[: end - begin]
            inside = inside_all[begin:end]
            logits = hs @ p["word_w"][c]
            logits += p["word_b"][c]
            if shift:
                logits -= logits.max(axis=1, keepdims=True)
            picked = logits[one, inside]
            e = np.exp(logits, out=logits)
            total = e @ wide
            some = order[begin:end]
            found[some] += picked - np.log(total)
            if grads is not None:
                e /= -total[:, None]
                e[one, inside] += 1
                grads["word_w"][c] += hs.T @ e
                grads["word_b"][c] += np.ones(len(e), e.dtype) @ e
                dh[some] += e @ p["word_w"][c].T
        return found, dh

    def gradients(self, previous, first, target, mask, h) -> tuple[dict, float, np.ndarray]:
        """Gradients of the window's log-likelihood, that likelihood, and the state carried out."""
        kept = self.steps(previous, first, h)
        grads = {name: np.zeros_like(v) for name, v in self.p.items()}
        live = np.flatnonzero(mask.ravel())
        found, dh_live = self.output(kept["out"][live], target.ravel()[live], grads)
        T, L = previous.shape
        dh_out = np.zeros((T * L, HIDDEN), np.float32)
        dh_out[live] = dh_live
        dh_out = dh_out.reshape(T, L, HIDDEN)
        H, back = HIDDEN, self.p["state"].T
        h0, z, r, n, u = (kept[k] for k in ("h", "z", "r", "n", "u"))
        # Factors that need no gradient are laid out for all steps, in the order in which a step multiplies.
        z_rest, r_rest = 1 - z, 1 - r
        one = np.stack([h0 - n, z_rest], axis=2)
        two = np.stack([z, 1 - n * n], axis=2)
        three = np.stack([u, r], axis=2)
        parts, by_gate = np.empty((T, L, 3, H), np.float32), np.empty((T, L, 2, H), np.float32)
        dg = parts.reshape(T, L, 3 * H)
        fresh, dh = first.any(axis=1).tolist(), np.zeros((L, H), np.float32)
        for t in range(T - 1, -1, -1):
            dh = dh + dh_out[t]
            both = np.multiply(dh[:, None, :], one[t], out=by_gate[t])
            both *= two[t]
            np.multiply(both[:, 0], z_rest[t], out=parts[t, :, 0])
            np.multiply(both[:, 1:], three[t], out=parts[t, :, 1:])
            to_r = parts[t, :, 1]
            to_r *= r[t]
            to_r *= r_rest[t]
            dh *= z[t]
            dh += dg[t] @ back
            if fresh[t]:
                dh[first[t]] = 0
        # Step by step from the last, as they would be added in the loop.
        grads["state"] += np.add.reduce(np.matmul(h0.transpose(0, 2, 1), dg)[::-1], axis=0)
        dx = dg.copy()
        dx[..., 2 * H :] = by_gate[:, :, 1]
        ids = previous.ravel()
        order = np.argsort(ids, kind="stable")
        starts = np.flatnonzero(np.diff(ids[order], prepend=-1))
        sums = np.add.reduceat(dx.reshape(T * L, -1)[order], starts, axis=0)
        grads["inputs"][ids[order][starts]] += sums
        return grads, float(found.sum()), kept["last"]


class Lanes:
    """Texts laid end to end in lanes of similar length, longest lane first.

    Cells are laid out for a stretch of time only: however long one text is, the
    lanes beside it take no room once their own texts have ended.
    """

    def __init__(self, texts: list[np.ndarray], size: int, width: int = LANES):
        self.start = size + 1
        order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
        fill: list[tuple[int, int, list[int]]] = [(0, k, []) for k in range(min(width, max(1, len(texts))))]
        for i in order:
            total, k, members = heapq.heappop(fill)
            members.append(i)
            heapq.heappush(fill, (total + len(texts[i]), k, members))
        fill.sort(key=lambda lane: (-lane[0], lane[1]))
        self.lengths = [total for total, _, _ in fill]
        self.ids = [np.concatenate([texts[i] for i in m]) if m else np.zeros(0, np.int32) for _, _, m in fill]
        self.ends = [np.cumsum([len(texts[i]) for i in m]) for _, _, m in fill]
        self.members = [np.array(m, np.int32) for _, _, m in fill]

    def cells(self, begin: int, steps: int, named: bool = True):
        """``target``, ``previous``, ``first``, ``mask`` and ``text``, all (time, lane), of lanes that still run.

        ``text`` is the index of the text that a cell belongs to, 0 everywhere unless ``named``.
        """
        live = sum(length > begin for length in self.lengths)
        shape = (max(0, min(steps, self.lengths[0] - begin)), live)
        target, text = np.zeros(shape, np.int32), np.zeros(shape, np.int32)
        previous = np.full(shape, self.start, np.int32)
        first, mask = np.zeros(shape, bool), np.zeros(shape, bool)
        for k in range(live):
            ids, ends = self.ids[k][begin : begin + steps], self.ends[k]
            n = len(ids)
            target[:n, k], mask[:n, k] = ids, True
            if named:
                of = np.searchsorted(ends, np.arange(begin, begin + n), side="right")
                text[:n, k] = self.members[k][of]
            previous[1:n, k] = ids[:-1]
            if begin:
                previous[0, k] = self.ids[k][begin - 1]
            starts = np.append(0, ends[:-1]) - begin
            starts = starts[(starts >= 0) & (starts < n)]
            first[starts, k] = True
            previous[starts, k] = self.start
        return target, previous, first, mask, text

    def windows(self, steps: int, named: bool = True, longest: int = 1):
        """The cells of one window after another; a stretch of windows is laid out at once.

        A window takes ``steps``, or up to ``longest`` times as many where only a part of the lanes still run.
        """
        stretch = steps * max(1, STRETCH // steps)
        for begin in range(0, self.lengths[0], stretch):
            laid, t = self.cells(begin, stretch, named), 0
            while t < len(laid[0]):
                k = int(np.count_nonzero(laid[3][t]))
                end = t + steps * max(1, min(longest, len(self.lengths) // k))
                yield tuple(part[t:end, :k] for part in laid)
                t = end


def lanes(texts: list[np.ndarray], size: int, width: int = LANES):
    """All cells of ``Lanes`` at once: ``target``, ``previous``, ``first``, ``mask`` and ``text``."""
    laid = Lanes(texts, size, width)
    return laid.cells(0, laid.lengths[0])


class Trainer:
    """Adagrad ascent over windows of a model's texts."""

    def __init__(self, model: Recurrent):
        self.model = model
        self.seen = {name: np.full_like(v, 1e-6) for name, v in model.p.items()}

    def fit(self, texts: list[np.ndarray]) -> float:
        model, total = self.model, 0.0
        laid = Lanes(texts, model.size)
        h = np.zeros((len(laid.lengths), HIDDEN), np.float32)
        for target, previous, first, mask, _ in laid.windows(WINDOW, named=False):
            grads, found, h = model.gradients(previous, first, target, mask, h[: target.shape[1]])
            total += found
            cells = np.float32(mask.sum())
            for name, g in grads.items():
                # Ids that the window lacks have no gradient, so their inputs stay as they are.
                rows = np.flatnonzero(np.bincount(previous.ravel())) if name == "inputs" else slice(None)
                g = g[rows] / cells
                seen = self.seen[name][rows] + g * g
                self.seen[name][rows] = seen
                model.p[name][rows] += RATE * g / np.sqrt(seen)
        return total


def score(model: Recurrent, texts: list[np.ndarray]) -> np.ndarray:
    """Natural log-likelihood of each text, with the state carried from its first to its last id."""
    found = np.zeros(len(texts))
    laid = Lanes(texts, model.size)
    h = np.zeros((len(laid.lengths), HIDDEN), np.float32)
    for target, previous, first, mask, text in laid.windows(SCORE_WINDOW, longest=LONGEST):
        kept = model.steps(previous, first, h[: target.shape[1]], keep=False)
        h = kept["last"]
        live = np.flatnonzero(mask.ravel())
        logs, _ = model.output(kept["out"][live], target.ravel()[live])
        found += np.bincount(text.ravel()[live], weights=logs, minlength=len(texts))
    return found
