"""Personal data: fixed patterns, and a character BiLSTM with CRF transitions that adds spans.

The network is trained in numpy on windows of ``WIDTH`` characters that overlap by half, whose labelled
spans are those of the patterns; ``TRAIN_WINDOWS`` bounds that sample, and half as many more show the
spans written in a way that the patterns miss (``rewritten``: brackets for ``@`` and dots, other separators, no
plus), so the network learns to add such spans. Those of digits must pass the tests of their kind (``plausible``).
It then reads every text whole, in windows of
``RUN`` characters that overlap by ``OVERLAP``. A span that a window's edge cuts is joined with its
piece in the next window, however many windows it runs through. The spans of all windows of a text
are reconciled at once: among overlapping ones the set with the largest total confidence stays. Base spans
always stay; a decoded span that touches one is dropped.

Null and empty texts have no spans. Offsets are code points. Equal rows give equal results; result
columns replace columns of the same name; an empty table gives an untrained model that adds nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from mnemospark.llm import shingles
from mnemospark.llm.staging import stage

KINDS = ("email", "ip", "card", "phone")
WIDTH, STEP = 64, 32
RUN, OVERLAP = 512, 64
TRAIN_WINDOWS, ROUNDS, BATCH, LEAST_STEPS = 3000, 12, 64, 420  # few windows are read more often
LEAST_RATE = 0.05  # of the learning rate, at the end
HIDDEN, EMBED = 16, 8
SLOPE = 0.25  # of the gates
CONFIDENCE = 0.9  # least probability of every label of an added span
REWRITTEN = 6  # other ways of writing, for each training window with a span
BLOCK = 512  # windows that run through the network together
TEXTS = 1024  # texts whose last windows are put in order of length

# ---- patterns -------------------------------------------------------------------------------

# The base patterns. Possessive forms where giving back could never lead to a match, so that long runs
# take linear time.
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TRIGGER = re.compile("[0-9@]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the patterns: leftmost, not overlapping within a kind; failing matches are dropped."""
    found = []
    if "@" in text:
        last = 0
        for m in DOMAIN.finditer(text):
            start = at = m.start()
            while start > last and text[start - 1] in LOCAL:
                start -= 1
            if start < at:
                found.append(("email", start, m.end()))
                last = m.end()
    if re.search("[0-9]", text):
        for m in IP.finditer(text):
            if all(len(p) < 4 and int(p) < 256 or int(p.lstrip("0")[:4] or 0) < 256 for p in m.groups()):
                found.append(("ip", *m.span()))
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 16:
                digits = m[0].replace(" ", "").replace("-", "")
                if 16 <= len(digits) <= 19 and luhn(digits):
                    found.append(("card", *m.span()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 8 <= sum(map(m[0].count, "0123456789")) <= 15:
                    found.append(("phone", *m.span()))
    return found


# ---- network --------------------------------------------------------------------------------

TAGS = 1 + 2 * len(KINDS)  # outside, then begin and inside of each kind


def _classes() -> np.ndarray:
    """Class of each ASCII character: digits together, letters by case, every other one alone."""
    table = np.arange(3, 131)
    table[ord("0"):ord("9") + 1] = 0
    table[ord("a"):ord("z") + 1] = 1
    table[ord("A"):ord("Z") + 1] = 2
    return table


CLASSES, OTHER = _classes(), 131
N_CLASSES = 132
PAD = N_CLASSES  # behind a text's end in a window; not read


def codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return np.where(points < 128, CLASSES[np.minimum(points, 127)], OTHER).astype(np.uint8)


def windows(text: str) -> list[int]:
    """Starts of the windows of ``WIDTH`` that cover a text."""
    return list(range(0, max(1, len(text) - STEP), STEP)) if text else []


def runs(text: str) -> list[int]:
    """Starts of the windows of ``RUN`` that cover a text."""
    return list(range(0, max(1, len(text) - OVERLAP), RUN - OVERLAP)) if text else []


# Activations without exp: a hard sigmoid for the gates, a hard tanh for what comes in, x / (1 + |x|) for what goes out.


def _gate(x):
    return np.clip(np.float32(SLOPE) * x + np.float32(0.5), 0, 1)


def _gate_slope(y):
    return SLOPE * ((y > 0) & (y < 1))


def _out(c):
    return c / (1 + np.abs(c))


@dataclass
class Model:
    """Weights by name; ``trained`` is false for the empty model."""

    weights: dict[str, np.ndarray] = field(default_factory=dict)
    trained: bool = False

    @classmethod
    def fresh(cls, seed: int = 9) -> Model:
        rng = np.random.default_rng(seed)
        w = {"embed": rng.normal(0, 0.5, (N_CLASSES, EMBED)), "out": rng.normal(0, 0.3, (2 * HIDDEN, TAGS)), "out_b": np.zeros(TAGS),
             "trans": np.zeros((TAGS, TAGS)), "first": np.zeros(TAGS)}
        for side in "fb":
            w["x" + side] = rng.normal(0, 0.3, (EMBED, 4 * HIDDEN))
            w["h" + side] = rng.normal(0, 0.3, (HIDDEN, 4 * HIDDEN))
            w["b" + side] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])
        return cls({k: v.astype(np.float32) for k, v in w.items()})

    def _run(self, x: np.ndarray, side: str, keep: bool):
        """Hidden states (T, B, H) over inputs (T, B, E), in the order given."""
        w, n, size = self.weights, len(x), HIDDEN
        h = c = np.zeros((x.shape[1], size), np.float32)
        into = x @ w["x" + side] + w["b" + side]
        states, memory = np.empty((n, x.shape[1], size), np.float32), []
        for t in range(n):
            g = into[t] + h @ w["h" + side]
            gate = _gate(g[:, :3 * size])
            i, f, o, u = gate[:, :size], gate[:, size:2 * size], gate[:, 2 * size:], np.clip(g[:, 3 * size:], -1, 1)
            before, c = c, f * c + i * u
            tc = _out(c)
            last, h = h, o * tc
            states[t] = h
            if keep:
                memory.append((i, f, o, u, before, tc, last))
        return states, memory

    def _back(self, x, side, memory, d_states, grads):
        w, size = self.weights, HIDDEN
        dh = dc = np.zeros_like(d_states[0])
        d_into = np.empty((len(x), x.shape[1], 4 * size), np.float32)
        for t in range(len(x) - 1, -1, -1):
            i, f, o, u, before, tc, last = memory[t]
            dh = dh + d_states[t]
            dc = dc + dh * o * (1 - np.abs(tc)) ** 2
            d = np.concatenate([dc * u * _gate_slope(i), dc * before * _gate_slope(f), dh * tc * _gate_slope(o), dc * i * (np.abs(u) < 1)], axis=1)
            d_into[t] = d
            grads["h" + side] += last.T @ d
            dh, dc = d @ w["h" + side].T, dc * f
        grads["x" + side] += np.einsum("tbe,tbg->eg", x, d_into)
        grads["b" + side] += d_into.sum((0, 1))
        return d_into @ w["x" + side].T

    def emissions(self, ids: np.ndarray, keep: bool = False):
        """Scores (T, B, tags) of windows (B, T)."""
        x = self.weights["embed"][ids.T]
        ahead, mf = self._run(x, "f", keep)
        back, mb = self._run(x[::-1], "b", keep)
        states = np.concatenate([ahead, back[::-1]], axis=2)
        return states @ self.weights["out"] + self.weights["out_b"], (x, states, mf, mb)

    def marginals(self, e: np.ndarray):
        """Label probabilities (T, B, tags) and what training needs: alpha, beta, log normaliser."""
        n, trans = len(e), self.weights["trans"]
        alpha, beta = np.empty_like(e), np.zeros_like(e)
        alpha[0] = e[0] + self.weights["first"]
        top = trans.max()
        kernel = np.exp(trans - top)
        for t in range(1, n):
            m = alpha[t - 1].max(1, keepdims=True)
            alpha[t] = e[t] + m + top + np.log(np.exp(alpha[t - 1] - m) @ kernel + 1e-30)
        for t in range(n - 2, -1, -1):
            s = e[t + 1] + beta[t + 1]
            m = s.max(1, keepdims=True)
            beta[t] = m + top + np.log(np.exp(s - m) @ kernel.T + 1e-30)
        m = alpha[-1].max(1)
        z = m + np.log(np.exp(alpha[-1] - m[:, None]).sum(1))
        return np.exp(alpha + beta - z[None, :, None]), alpha, beta, z

    def step(self, ids: np.ndarray, tags: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the mean negative log likelihood of the labels (B, T)."""
        e, (x, states, mf, mb) = self.emissions(ids, keep=True)
        prob, alpha, beta, z = self.marginals(e)
        n, size = tags.shape[1], len(ids)
        truth = np.eye(TAGS, dtype=np.float32)[tags.T]
        de = ((prob - truth) / size).astype(np.float32)
        grads = {k: np.zeros_like(v) for k, v in self.weights.items()}
        for t in range(1, n):
            pair = np.exp(alpha[t - 1][:, :, None] + self.weights["trans"] + (e[t] + beta[t])[:, None, :] - z[:, None, None])
            grads["trans"] += (pair.sum(0) - truth[t - 1].T @ truth[t]) / size
        grads["first"] += de[0].sum(0)
        grads["out"] += np.einsum("tbh,tbk->hk", states, de)
        grads["out_b"] += de.sum((0, 1))
        ds = de @ self.weights["out"].T
        dx = self._back(x, "f", mf, ds[:, :, :HIDDEN], grads)
        dx = dx + self._back(x[::-1], "b", mb, ds[::-1, :, HIDDEN:], grads)[::-1]
        np.add.at(grads["embed"], ids.T, dx)
        return grads

    def fit(self, ids: np.ndarray, tags: np.ndarray, rounds: int = ROUNDS, rate: float = 0.03, seed: int = 9) -> Model:
        """Adam over shuffled batches; the rate falls evenly, so that the weights come to rest."""
        rng, n = np.random.default_rng(seed), 0
        first, second = ({k: np.zeros_like(v) for k, v in self.weights.items()} for _ in range(2))
        rounds = max(rounds, -(-LEAST_STEPS * BATCH // max(1, len(ids))))
        steps = rounds * -(-len(ids) // BATCH)
        for _ in range(rounds):
            order = rng.permutation(len(ids))
            for at in range(0, len(ids), BATCH):
                n += 1
                now = rate * max(LEAST_RATE, 1 - n / steps)
                for k, g in self.step(ids[order[at:at + BATCH]], tags[order[at:at + BATCH]]).items():
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.99 * second[k] + 0.01 * g * g
                    self.weights[k] = self.weights[k] - np.float32(now) * (first[k] / (1 - 0.9 ** n)) / (np.sqrt(second[k] / (1 - 0.99 ** n)) + 1e-8)
        self.weights = {k: v.astype(np.float32) for k, v in self.weights.items()}
        self.trained = len(ids) > 0
        return self

    def scores(self, ids: np.ndarray) -> np.ndarray:
        """``emissions`` without what training keeps. Windows end at their first ``PAD``; what lies behind is surely outside.

        The longest windows stand first, so those that reach a place are a prefix. A step's matrix product takes
        state, embedding and bias at once; what a step needs is small enough to stay in a core's cache.
        """
        w, size, (count, n) = self.weights, HIDDEN, ids.shape
        lengths = (ids != PAD).sum(1)
        order = np.argsort(-lengths, kind="stable")
        chars = np.ascontiguousarray(np.where(ids == PAD, 0, ids)[order].T)
        alive = np.searchsorted(-lengths[order], -np.arange(n), side="left")  # windows longer than t
        chars, embed = chars.astype(np.intp), np.ascontiguousarray(w["embed"].T, np.float32)
        fed, scored = np.ones((size + EMBED + 1, count), np.float32), np.empty((TAGS, count), np.float32)
        # All four parts are cut to 0 and 1; the last, less a half, and the memory stand for half of their values.
        rows = np.concatenate([np.full(3 * size, SLOPE), np.full(size, 0.5)])
        shift = 0.5
        zero, one, half = np.float32(0), np.float32(1), np.float32(0.5)
        g, u, c = np.empty((4 * size, count), np.float32), np.empty((size, count), np.float32), np.empty((size, count), np.float32)
        out = np.zeros((n, TAGS, count), np.float32) + w["out_b"].astype(np.float32)[:, None]
        for side, times, part in (("f", range(n), w["out"][:size]), ("b", range(n - 1, -1, -1), w["out"][size:])):
            outer = np.ascontiguousarray(part.T, np.float32)
            inner = np.ascontiguousarray((np.concatenate([w["h" + side], w["x" + side], w["b" + side][None]]) * rows).T, np.float32)
            inner[:, -1] += shift
            fed[:size] = c[:] = 0
            for t in times:
                k = alive[t]
                if not k:
                    continue
                z, v, memory = g[:, :k], u[:, :k], c[:, :k]
                fed[size:-1, :k] = embed.take(chars[t, :k], axis=1)
                np.matmul(inner, fed[:, :k], out=z)
                gate, new = z[:3 * size], z[3 * size:]
                z.clip(zero, one, out=z)
                new -= half
                memory *= gate[size:2 * size]
                new *= gate[:size]
                memory += new
                np.abs(memory, out=v)
                v += half
                np.divide(memory, v, out=v)
                np.multiply(v, gate[2 * size:], out=fed[:size, :k])
                out[t, :, :k] += np.matmul(outer, fed[:size, :k], out=scored[:, :k])
        ends = lengths[order]
        if ends[-1] < n:
            behind = np.arange(n)[:, None] >= ends
            out = np.where(behind[:, None], np.where(np.arange(TAGS) == 0, np.float32(0), np.float32(-50))[None, :, None], out)
        if (order[1:] < order[:-1]).any():
            out = out[:, :, np.argsort(order, kind="stable")]
        return out.transpose(0, 2, 1)

    def outside(self, e: np.ndarray) -> np.ndarray:
        """Windows (B) whose best labels are surely all outside: no label gains what its scores lose, whatever stands around it."""
        trans, first = self.weights["trans"], self.weights["first"]
        e = e.transpose(0, 2, 1)
        # What a run of labels gains at most: by its first label, by each more, and by the step back outside.
        begin, more, back = trans[0, 1:] - trans[0, 0], trans[1:, 1:].max(0) - trans[0, 0], float(trans[1:, 0].max() - trans[0, 0])
        opened, gone = e[:, 1] + begin[0], e[:, 1] + more[0]
        for k in range(1, TAGS - 1):
            np.maximum(opened, e[:, 1 + k] + begin[k], out=opened)
            np.maximum(gone, e[:, 1 + k] + more[k], out=gone)
        opened -= e[:, 0]
        gone -= e[:, 0]
        opened[0] = (e[0, 1:] + (first[1:] - first[0])[:, None]).max(0) - e[0, 0]
        gain = opened[0].copy()
        most = gain.copy()
        for t in range(1, len(e)):
            gain += gone[t]
            np.maximum(gain, opened[t], out=gain)
            np.maximum(most, gain, out=most)
        return np.maximum(most + back, gain) < 0

    def unlabelled(self, e: np.ndarray) -> np.ndarray:
        """Windows (B) for which no path scores more than the one that is outside throughout; exact, without the paths."""
        e = np.ascontiguousarray(e.transpose(0, 2, 1))
        trans = self.weights["trans"]
        best = e[0] + self.weights["first"][:, None]
        flat = best[0].copy()
        for t in range(1, len(e)):
            best = (best[:, None] + trans[:, :, None]).max(0) + e[t]
            flat += trans[0, 0] + e[t, 0]
        return flat >= best.max(0) - 1e-3

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best labels (B, T) by the CRF and their probabilities."""
        return self.best(self.scores(ids))

    def best(self, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``decode`` from scores (T, B, tags)."""
        best = self.path(e)
        return best, self.sureness(e, best)

    def sureness(self, e: np.ndarray, best: np.ndarray) -> np.ndarray:
        """Probabilities (B, T) of the labels (B, T)."""
        return np.take_along_axis(self.marginals(e)[0], best.T[:, :, None], 2)[:, :, 0].T

    def path(self, e: np.ndarray) -> np.ndarray:
        """Best labels (B, T) by the CRF."""
        trans, n = self.weights["trans"], len(e)
        e = np.ascontiguousarray(e.transpose(0, 2, 1))
        score = np.empty_like(e)
        score[0] = e[0] + self.weights["first"][:, None]
        for t in range(1, n):
            np.add((score[t - 1][:, None] + trans[:, :, None]).max(0), e[t], out=score[t])
        best = np.empty((n, e.shape[2]), np.int64)
        best[-1] = score[-1].argmax(0)
        for t in range(n - 1, 0, -1):
            best[t - 1] = (score[t - 1] + trans[:, best[t]]).argmax(0)
        return best.T


def labels(text: str, start: int, spans: list[tuple[str, int, int]]) -> np.ndarray:
    tags = np.zeros(WIDTH, np.int64)
    for kind, a, b in spans:
        a, b, k = max(a - start, 0), min(b - start, WIDTH), 1 + 2 * KINDS.index(kind)
        if a < b and not tags[a:b].any():
            tags[a:b], tags[a] = k + 1, k
    return tags


def padded(ids: np.ndarray, start: int, width: int = WIDTH, fill: int = CLASSES[10]) -> np.ndarray:
    piece = ids[start:start + width]
    return np.concatenate([piece, np.full(width - len(piece), fill, piece.dtype)]) if len(piece) < width else piece


# Ways of writing that the patterns miss.
AT = ("[at]", "(at)", " [at] ", " (at) ", "{at}", " @ ")
DOT = ("[dot]", "(dot)", " [dot] ", " (dot) ", "[.]", ".")
IP_DOT = ("[.]", "(.)", "[dot]", " . ")
CARD_GAP = (".", "/", "_", " . ")
PHONE_GAP = ("/", "_", " / ")


def rewritten(kind: str, found: str, pick: int) -> str:
    """A span of a pattern written in another way, by the number ``pick``."""
    choose = lambda some, by=1: some[pick // by % len(some)]
    if kind == "email":
        name, host = found.split("@")
        return name + choose(AT) + host.replace(".", choose(DOT, 6))
    if kind == "ip":
        return found.replace(".", choose(IP_DOT))
    digits = "".join(filter(str.isdigit, found))
    if kind == "card":
        return choose(CARD_GAP).join(digits[i:i + 4] for i in range(0, len(digits), 4))
    groups = re.findall("[0-9]+", found)
    if len(groups) < 3:
        groups = [digits[:2], digits[2:5], digits[5:]]
    return choose(("+", "00", "+ ", "(+"), 3) + choose(PHONE_GAP).join(groups)


def plausible(kind: str, found: str) -> bool:
    """Whether a span of digits passes the test of its kind; emails have none."""
    numbers = re.findall("[0-9]+", found)
    digits = "".join(numbers)
    if kind == "ip":
        return len(numbers) == 4 and all(len(n) < 4 and int(n) < 256 for n in numbers)
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 8 <= len(digits) <= 15


def window_rows(text: str, start: int, spans: list[tuple[str, int, int]], pick: int) -> list[tuple[str, int, list[tuple[str, int, int]]]]:
    """A window of a text, and ``REWRITTEN`` more with its first span rewritten if one begins in its first half."""
    out = [(text, start, spans)]
    inside = [s for s in spans if start <= s[1] < start + WIDTH // 2]
    for n in range(REWRITTEN if inside else 0):
        kind, a, b = min(inside, key=lambda s: s[1])
        low, high = max(0, start - WIDTH), b + 2 * WIDTH  # only the text around matters
        new = rewritten(kind, text[a:b], int(shingles.mix(np.uint64(pick + n)) >> np.uint64(8)))
        around = text[low:a] + new + text[b:high]
        mine = (kind, a - low, a - low + len(new))
        out.append((around, start - low, [mine] + [s for s in base_spans(around) if s[2] <= mine[1] or s[1] >= mine[2]]))
    return out


@dataclass
class Piece:
    """Part of a span in one window, with the probabilities of its labels."""

    start: int
    end: int
    kind: int
    prob: np.ndarray
    before: bool  # it begins where the window does, within the text
    after: bool  # it ends where the window does, within the text


def cut_out(tags: np.ndarray, prob: np.ndarray, start: int, length: int) -> list[Piece]:
    """Pieces of the window at ``start`` of a text of so many characters."""
    out, width = [], min(len(tags), length - start)
    tags = tags[:width]
    begins = np.flatnonzero(tags % 2 == 1)
    # A label ends where the next one is not the inside of its kind.
    goes_on = (tags[1:] > 0) & (tags[1:] % 2 == 0) & (tags[1:] - tags[:-1] == tags[:-1] % 2)
    stops = np.append(np.flatnonzero(~goes_on), width - 1)
    for t, end in zip(begins.tolist(), (stops[np.searchsorted(stops, begins)] + 1).tolist()):
        out.append(Piece(start + t, start + end, int(tags[t]) // 2, prob[t:end], t == 0 and start > 0, end == width and start + end < length))
    return out


def lies_free(tags: np.ndarray, start: int, length: int, base: list[tuple[str, int, int]]) -> bool:
    """Whether a piece of the window at ``start`` touches no base span."""
    return any(not any(a < p.end and b > p.start for _, a, b in base) for p in cut_out(tags, tags, start, length))


def chosen(e: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Some windows of scores (T, B, tags), that lie in memory as (T, tags, B)."""
    return e.transpose(0, 2, 1).take(rows, axis=2).transpose(0, 2, 1)


def joined(pieces: list[Piece]) -> list[tuple[int, int, int, float]]:
    """Spans (start, end, kind, confidence) from a text's pieces in the order of their windows.

    A piece that begins with its window goes on the one that reaches into it from the window before; without such
    a one it is void, since that window has seen the place. What both windows label counts with the larger probability.
    """
    out, cut = [], None
    for p in pieces:
        if p.before:
            if cut is None or cut.kind != p.kind or not cut.start <= p.start < cut.end:
                continue
            prob = np.zeros(max(cut.end, p.end) - cut.start, p.prob.dtype)
            prob[:len(cut.prob)] = cut.prob
            at = p.start - cut.start
            prob[at:at + len(p.prob)] = np.maximum(prob[at:at + len(p.prob)], p.prob)
            p = Piece(cut.start, p.end, p.kind, prob[:p.end - cut.start], False, p.after)
        if p.after:
            cut = p
        else:
            out.append((p.start, p.end, p.kind, float(p.prob.min())))
    return out


def reconcile(spans: list[tuple[int, int, int, float]]) -> list[tuple[int, int, int, float]]:
    """Of (start, end, kind, confidence) the non-overlapping set with the largest sum of confidences."""
    spans = sorted(set(spans), key=lambda s: (s[1], s[0], s[2]))
    ends = [s[1] for s in spans]
    best, back = [0.0], []
    for i, (a, _, _, score) in enumerate(spans):
        j = int(np.searchsorted(ends[:i], a, side="right"))
        take = best[j] + score
        back.append((take > best[i], j))
        best.append(max(take, best[i]))
    out, i = [], len(spans)
    while i:
        taken, j = back[i - 1]
        if taken:
            out.append(spans[i - 1])
        i = j if taken else i - 1
    return out[::-1]


def added_spans(model: Model, texts: list[str], base: list[list[tuple[str, int, int]]]) -> list[list[tuple[str, int, int]]]:
    """Spans of the network that touch no base span, for each text."""
    if not model.trained:
        return [[] for _ in texts]
    pieces: list[list[tuple[int, list[Piece]]]] = [[] for _ in texts]

    held: list[tuple[list[tuple[int, int]], np.ndarray]] = []  # windows with labels, and their scores

    def flush(some: list[tuple[int, int, np.ndarray]]):
        some.sort(key=lambda w: w[1] - len(texts[w[0]]))  # the longest first
        e = model.scores(np.stack([ids for _, _, ids in some]))
        rows = np.flatnonzero(~model.outside(e))
        e = chosen(e, rows)
        live = np.flatnonzero(~model.unlabelled(e))
        if len(live):
            held.append(([some[r][:2] for r in rows[live].tolist()], chosen(e, live)))
        if sum(len(names) for names, _ in held) >= BLOCK:
            label()

    def label():
        if not held:
            return
        names, e = [w for some, _ in held for w in some], np.concatenate([e for _, e in held], axis=1)
        held.clear()
        tags = model.path(e)
        # Probabilities decide about spans that touch no base span; windows where every piece does need none.
        rows = [row for row, (i, start) in enumerate(names) if lies_free(tags[row], start, len(texts[i]), base[i])]
        prob = dict(zip(rows, model.sureness(chosen(e, np.array(rows)), tags[rows]))) if rows else {}
        none = np.zeros(len(e), e.dtype)
        for row, (i, start) in enumerate(names):
            pieces[i].append((start, cut_out(tags[row], prob.get(row, none), start, len(texts[i]))))

    full, short = [], []  # windows of the whole width, and the last ones of texts
    for i, text in enumerate(texts):
        ids = codes(text)
        for start in runs(text):
            queue = full if start + RUN <= len(text) else short
            queue.append((i, start, padded(ids, start, RUN, PAD)))
            if len(full) == BLOCK:
                flush(full)
                full = []
    short.sort(key=lambda w: w[1] - len(texts[w[0]]))
    rest = full + short
    for at in range(0, len(rest), BLOCK):
        flush(rest[at:at + BLOCK])
    label()
    result = []
    for text, found, fixed in zip(texts, pieces, base):
        fixed = sorted((a, b) for _, a, b in fixed)
        starts = [a for a, _ in fixed]
        free = []
        for a, b, k, score in joined([p for _, some in sorted(found, key=lambda w: w[0]) for p in some]):
            at = int(np.searchsorted(starts, b))
            if score >= CONFIDENCE and not any(e > a for _, e in fixed[:at]) and plausible(KINDS[k], text[a:b]):
                free.append((a, b, k, score))
        result.append([(KINDS[k], a, b) for a, b, k, _ in reconcile(free)])
    return result


# ---- Spark ----------------------------------------------------------------------------------

SPANS = "array<struct<kind:string,start:int,end:int,base:boolean>>"


def train(docs: DataFrame, text_col: str = "text", key: str = "doc_id", sample: int = TRAIN_WINDOWS) -> Model:
    """Fit on ``sample`` windows of all texts: half hold a span, a quarter only a digit or ``@``, a quarter neither.

    Of each sort the first in the order of a hash are taken; a task hands on no more than could be among them. Those with
    a span that begins in their first half come again, rewritten, which are at most half of ``sample`` more.
    """
    most = (sample // 2, sample // 4, sample // 4)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[list] = [[] for _ in most]
        bound = [2 ** 63] * len(most)
        for batch in batches:
            for k, text in zip(*(c.to_pylist() for c in batch.columns)):
                starts, spans = np.arange(0, max(1, len(text) - STEP), STEP), base_spans(text)
                with np.errstate(over="ignore"):
                    h = shingles.mix(np.uint64(k & (2 ** 64 - 1)) + starts.astype(np.uint64) * shingles.ODD) >> np.uint64(1)
                spanned = np.zeros(len(starts), bool)
                for _, a, b in spans:
                    spanned[max(0, (a - WIDTH) // STEP + 1):(b - 1) // STEP + 1] = True
                # Most texts have no window that could still be among the first.
                for n in np.flatnonzero(np.where(spanned, h < np.uint64(bound[0]), h < np.uint64(max(bound[1:])))).tolist():
                    s = 0 if spanned[n] else 1 if TRIGGER.search(text, n * STEP, n * STEP + WIDTH) else 2
                    if h[n] < bound[s]:
                        kept[s].append((int(h[n]), text, n * STEP, spans))
                for s, rows in enumerate(kept):
                    if len(rows) > 2 * most[s]:
                        rows.sort(key=lambda r: r[0])
                        last = rows[most[s] - 1][0]
                        kept[s] = [r for r in rows if r[0] <= last][:2 * most[s]]
                        bound[s] = last + 1
        rows: list[tuple] = []
        for s, some in enumerate(kept):
            some.sort(key=lambda r: r[0])
            made, last = 0, -1  # rewritten windows: their first ones suffice as well
            for at, (h, text, start, own) in enumerate(some):
                if at >= most[s] and h > some[most[s] - 1][0]:
                    break
                found = window_rows(text, start, own, h) if made < most[0] or h == last else [(text, start, own)]
                made, last = made + len(found) - 1, h
                rows += [(h, s + (n > 0) * len(most), padded(codes(x[at:at + WIDTH]), 0).astype(np.int16).tobytes(), labels(x, at, spans).astype(np.int8).tobytes())
                         for n, (x, at, spans) in enumerate(found)]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int32(), pa.binary(), pa.binary()))], ["h", "sort", "ids", "tags"])

    texts = docs.where(F.length(text_col) > 0).select(F.xxhash64(key, text_col).alias("k"), F.col(text_col).alias("text"))
    rows = stage(texts.mapInArrow(cut, "h long, sort int, ids binary, tags binary"), "pii-windows")
    taken = [r for s, n in enumerate((*most, most[0])) for r in rows.where(F.col("sort") == s).orderBy("h", "ids").limit(n).collect()]
    if not taken:
        return Model.fresh()
    ids = np.stack([np.frombuffer(r["ids"], np.int16) for r in taken]).astype(np.int64)
    return Model.fresh().fit(ids, np.stack([np.frombuffer(r["tags"], np.int8) for r in taken]).astype(np.int64))


def all_spans(model: Model, texts: list[str]) -> list[list[tuple[str, int, int, bool]]]:
    base = list(map(base_spans, texts))
    order = {kind: i for i, kind in enumerate(KINDS)}
    return [sorted([(*s, True) for s in fixed] + [(*s, False) for s in extra], key=lambda s: (order[s[0]], s[1]))
            for fixed, extra in zip(base, added_spans(model, texts, base))]


def _pieces(batch: pa.Array) -> Iterator[list[str]]:
    for start in range(0, len(batch), TEXTS):
        yield [t or "" for t in batch.slice(start, TEXTS).to_pylist()]


def spans(text: Column | str, model: Model) -> Column:
    """All spans of a text, by kind as listed, then start."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))
        for batch in batches:
            yield pa.array([[{"kind": k, "start": a, "end": b, "base": f} for k, a, b, f in found] for texts in _pieces(batch) for found in all_spans(model, texts)], kind)

    return F.arrow_udf(run, SPANS, F.ArrowUDFType.SCALAR_ITER)(text)


def redacted(text: Column | str, model: Model) -> Column:
    """The text with each span, overlapping ones together, replaced by its kind in angle brackets."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = []
            for texts in _pieces(batch):
                for whole, found in zip(texts, all_spans(model, texts)):
                    parts, at = [], 0
                    for kind, a, b, _ in sorted(found, key=lambda s: (s[1], -s[2])):
                        if a >= at:
                            parts += [whole[at:a], f"<{kind.upper()}>"]
                        at = max(at, b)
                    out.append("".join([*parts, whole[at:]]))
            yield pa.array(out, pa.string())

    return F.arrow_udf(run, "string", F.ArrowUDFType.SCALAR_ITER)(text)


def find(docs: DataFrame, model: Model, text_col: str = "text", spans_col: str = "spans") -> DataFrame:
    return docs.withColumn(spans_col, spans(F.coalesce(F.col(text_col), F.lit("")), model))


def redact(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with its texts redacted; null stays null."""
    return docs.withColumn(text_col, F.when(F.col(text_col).isNotNull(), redacted(F.coalesce(F.col(text_col), F.lit("")), model)))
