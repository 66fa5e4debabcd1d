"""Secret scans: patterns first, then a character convolutional network over every candidate.

A candidate is a run of at least ``MIN_BODY`` of [A-Za-z0-9+/_.=-], or the value of a pattern's match.
The patterns label candidates: one that lies in a match is a secret, any other is not.  All labelled findings train
a small network in numpy on the characters of the candidate and of what stands around it.  Patterns find few
shapes, so secrets are also spelt anew, as keys of other kinds (``SPELLINGS``) in the surroundings of other runs, and in
training the surroundings of every second row are hidden: the shape of a value counts, the keyword helps.  A quarter
is held back: its scores are calibrated by Platt scaling, and the threshold is the highest one
that still finds ``RECALL`` of the held-back secrets, as they stand and with their surroundings hidden, and
``RECALL_OF_KINDS`` of the held-back values of each kind.  Candidates above it that touch no pattern's match are
added as kind ``model``; matches of patterns always stay.

Texts are dealt into shards by a hash, about ``SHARD_BYTES`` each.  One task trains a network on the first shard; from
there the other shards go on, each in a task that streams it, and the mean of their weights counts.  Secrets are few
against other runs, so each is dealt to as many shards as it takes for ``SECRETS`` in each.  Held-back findings are counted by their
logits in steps of 1 / ``STEPS``.  Nothing depends on how Spark splits the table; equal texts and equal windows of secrets teach once.

All runs of a batch are cut out and scored as arrays.  Surroundings can add a bounded amount, so they are looked at only
where they can decide; the result is that of scoring every window whole.

Defined cases: a null or empty text has no spans.  Equal rows get equal spans.  If what is fitted or what is held
back lacks one of the labels, nothing is added.  Candidates of any length count whole as spans; one longer
than the network's window is seen in overlapping windows, and the highest score counts.  An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptally.llm.storage import saved
from shoptally.llm.words import slices

# The patterns, in the order in which spans with one start are listed.
KINDS = ("assign", "access", "hex", "model")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KEYWORDS = ("passw", "secret", "token", "apikey", "api_key")
MIN_VALUE, MIN_ACCESS, MIN_BODY = 8, 16, 8
BODY = re.compile(r"[A-Za-z0-9+/_.=-]{%d,}" % MIN_BODY)
IN_BODY = np.array([BODY.fullmatch(chr(i) * MIN_BODY) is not None for i in range(128)])
#: Classes of characters: 0 for none, ASCII 32 to 126 as 1 to 95, white space 96, others (127 and above) 97.
CLASS_OF = np.array([0 if i == 0 else 96 if 9 <= i <= 13 else i - 31 if 32 <= i < 127 else 97 for i in range(128)], np.uint8)

#: Text of a shard, secrets that a shard has at least, and windows of other runs and of secrets in a step of training.
SHARD_BYTES = 8 << 20
SECRETS = 256
STEP = (1024, 64)
#: Windows that a shard shuffles at once, and windows that the first shard shows in all, over and over if it has fewer.
SHUFFLED = 32_768
SHOWN = 500_000
#: Rates of training, on the first shard and on the others.
RATE, LATER_RATE = 0.01, 0.002
#: Held-back logits are counted in steps of 1 / STEPS.
STEPS = 256
RECALL = 0.98
#: The same for each kind of ``SPELLINGS``, and how many values of a kind are made.
RECALL_OF_KINDS = 0.95
VARIANTS = 240

# Ways in which keys are spelt, as prefix or none, alphabet, least and greatest length.
_UPPER, _LOWER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
SPELLINGS = {
    "hexadecimal": (False, _DIGITS + "abcdef", 16, 48),
    "letters and digits": (False, _UPPER + _LOWER + _DIGITS, 16, 48),
    "small letters and digits": (False, _LOWER + _DIGITS, 16, 48),
    "capitals and digits": (False, _UPPER + _DIGITS, 16, 40),
    "base 64": (False, _UPPER + _LOWER + _DIGITS + "+/", 24, 48),
    "behind a prefix": (True, _UPPER + _LOWER + _DIGITS, 16, 40),
    "letters": (False, _UPPER + _LOWER, 16, 40),
}
BEFORE, BODY_LENGTH, AFTER = 24, 48, 8
LENGTH = BEFORE + BODY_LENGTH + AFTER
#: A candidate up to so long is convolved in a narrower array.
SHORT = 16
#: Widths of the arrays in which candidates are convolved, except in batches of texts.
WIDTHS = (10, SHORT, BODY_LENGTH)
#: Windows that are scored at once, and rows that are convolved at once.
BATCH = 4096
ROWS = 512


class Span(NamedTuple):
    start: int
    kind: int
    end: int

    def __str__(self) -> str:
        return f"{KINDS[self.kind]}:{self.start}:{self.end}"


def base_spans(text: str) -> tuple[list[Span], list[tuple[int, int]]]:
    """Spans that the patterns find, in order, and where the values of assignments stand."""
    found, values = [], []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= MIN_VALUE:
                found.append(Span(m.start(), 0, m.end()))
                values.append(m.span(2))
    found += [Span(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    found += [Span(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found), values


def candidates(text: str, base: list[Span], values: list[tuple[int, int]]) -> list[tuple[int, int, bool]]:
    """(start, end, whether it touches a match) of every candidate."""
    bodies = {m.span() for m in BODY.finditer(text)}.union(values)
    merged: list[list[int]] = []
    for b in base:
        if merged and b.start < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b.end)
        else:
            merged.append([b.start, b.end])
    out, at = [], 0
    for start, end in sorted(bodies):
        while at < len(merged) and merged[at][1] <= start:
            at += 1
        out.append((start, end, at < len(merged) and merged[at][0] < end))
    return out


def window(text: str, start: int, end: int) -> str:
    """The characters that the network sees of a candidate that is no longer than ``BODY_LENGTH``, at fixed places."""
    before, after = text[max(0, start - BEFORE) : start], text[end : end + AFTER]
    return before.rjust(BEFORE, "\0") + text[start:end].ljust(BODY_LENGTH, "\0") + after.ljust(AFTER, "\0")


def windows(text: str, start: int, end: int) -> list[str]:
    """Windows over the whole length of a candidate, each half over the one before."""
    last = end - BODY_LENGTH
    if last <= start:
        return [window(text, start, end)]
    return [window(text, at, at + BODY_LENGTH) for at in (*range(start, last, BODY_LENGTH // 2), last)]


class Runs:
    """All candidates of a batch of texts at once, over one array of the characters of all texts.

    ``found`` has the result of ``base_spans`` for each text.  Windows are those of ``windows`` and their characters
    those of ``encode``, as arrays.
    """

    def __init__(self, texts: list[str], found: list[tuple[list[Span], list[tuple[int, int]]]]) -> None:
        self.begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
        points = np.frombuffer(("\0".join(texts) + "\0").encode("utf-32-le", "surrogatepass"), "<u4")
        points = np.minimum(points, 127)
        self.codes = CLASS_OF[points]
        edges = np.diff(IN_BODY[points].astype(np.int8), prepend=0)
        starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        long = ends - starts >= MIN_BODY
        self.starts, self.ends = starts[long], ends[long]
        at = self.begins.tolist()
        spans = [(at[i] + b.start, at[i] + b.end) for i, (base, _) in enumerate(found) for b in base]
        self.values = [(at[i] + v[0], at[i] + v[1]) for i, (_, values) in enumerate(found) for v in values]
        # Spans in order of their starts, with the furthest end so far: a run is touched by those before its end
        # if one of them ends behind its start.
        spans.sort()
        span_starts = np.array([x[0] for x in spans], np.int64)
        furthest = np.maximum.accumulate(np.array([0, *(x[1] for x in spans)], np.int64))
        self.touched = furthest[np.searchsorted(span_starts, self.ends)] > self.starts

    def rows(self, starts: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.begins, starts, side="right") - 1

    @staticmethod
    def windowed(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which run each window is of, where it begins and where it ends."""
        step, beyond = BODY_LENGTH // 2, np.maximum(ends - starts - BODY_LENGTH, 0)
        count = -(-beyond // step) + 1
        of = np.repeat(np.arange(len(starts)), count)
        nth = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
        begin = starts[of] + np.minimum(nth * step, beyond[of])
        return of, begin, np.minimum(begin + BODY_LENGTH, ends[of])

    def _taken(self, at: np.ndarray, there: np.ndarray) -> np.ndarray:
        return np.where(there, self.codes[np.clip(at, 0, len(self.codes) - 1)], 0)

    def bodies(self, begin: np.ndarray, end: np.ndarray, width: int = BODY_LENGTH) -> np.ndarray:
        at = begin[:, None] + np.arange(width)
        return self._taken(at, at < end[:, None])

    def around(self, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        row = self.rows(begin)
        before, after = begin[:, None] + np.arange(-BEFORE, 0), end[:, None] + np.arange(AFTER)
        first, last = self.begins[row][:, None], self.begins[row + 1][:, None] - 1
        return self._taken(before, before >= first), self._taken(after, after < last)

    def windows(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        before, after = self.around(begin, end)
        return np.concatenate([before, self.bodies(begin, end), after], axis=1)

    def shown(self, starts: np.ndarray, ends: np.ndarray) -> Iterator[np.ndarray]:
        """The windows of runs, in order, at most ``BATCH`` at once."""
        _, begin, end = self.windowed(starts, ends)
        for i in range(0, len(begin), BATCH):
            yield self.windows(begin[i : i + BATCH], end[i : i + BATCH])

    def secret(self, net: CharNet, threshold: float) -> list[tuple[int, int, int]]:
        """(text, start, end) of the untouched runs that the network takes for secrets, by their best window."""
        starts, ends = self.starts[~self.touched], self.ends[~self.touched]
        of, begin, end = self.windowed(starts, ends)
        hits: list[np.ndarray] = []
        short = end - begin <= SHORT
        for chosen, width in ((np.flatnonzero(short), SHORT), (np.flatnonzero(~short), BODY_LENGTH)):
            for i in range(0, len(chosen), BATCH):
                part = chosen[i : i + BATCH]
                logits = net.body_logits(self.bodies(begin[part], end[part], width))
                # Only windows that can come to the threshold need their surroundings.
                able = net.calibrated(logits + np.sign(net.scale[0]) * (net.reach() + 1e-6)) >= threshold
                part, logits = part[able], logits[able]
                if len(part):
                    logits = logits + net.around_logits(*self.around(begin[part], end[part]))
                    hits.append(of[part[net.calibrated(logits) >= threshold]])
        which = np.unique(np.concatenate(hits)) if hits else np.zeros(0, np.int64)
        row = self.rows(starts[which])
        first = self.begins[row]
        return list(zip(row.tolist(), (starts[which] - first).tolist(), (ends[which] - first).tolist(), strict=True))


# --- network --------------------------------------------------------------------------------------


def encode(windows: list[str]) -> np.ndarray:
    """The classes of all characters of windows that are equally long."""
    points = np.frombuffer("".join(windows).encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(windows), -1)
    return CLASS_OF[np.minimum(points, 127)]


class CharNet:
    """Embedding and two convolutions: one over the candidate, one over its surroundings.

    Of each filter over the candidate the maximum and the mean count, of each over what stands before and after it the
    maximum.  What the surroundings add to the logit goes through a tanh, so it has a bound (``reach``), and a
    candidate that cannot come to the threshold with it need not have its surroundings looked at.
    """

    CLASSES, WIDTH, SIZE, FILTERS, AROUND = 98, 5, 8, 24, 8

    def __init__(self, seed: int = 11) -> None:
        r = np.random.default_rng(seed)
        taps = self.WIDTH * self.SIZE
        self.embed = r.normal(0, 0.3, (self.CLASSES, self.SIZE))
        self.kernel = r.normal(0, 1 / np.sqrt(taps), (taps, self.FILTERS))
        self.bias = np.zeros(self.FILTERS)
        self.out = r.normal(0, 0.2, 2 * self.FILTERS)
        self.out_bias = np.zeros(1)
        self.around = r.normal(0, 1 / np.sqrt(taps), (taps, self.AROUND))
        self.around_bias = np.zeros(self.AROUND)
        self.around_out = r.normal(0, 0.2, 2 * self.AROUND)
        self.gain = np.ones(1)
        self.scale = np.array([1.0, 0.0])
        self.parts = [np.arange(BEFORE, BEFORE + BODY_LENGTH), np.r_[0:BEFORE, BEFORE + BODY_LENGTH : LENGTH]]

    def weights(self) -> list[np.ndarray]:
        own = [self.embed, self.kernel, self.bias, self.out, self.out_bias]
        return [*own, self.around, self.around_bias, self.around_out, self.gain]

    def alone(self, codes: np.ndarray) -> np.ndarray:
        """The candidates without what stands around them."""
        out = codes.copy()
        out[:, self.parts[1]] = 0
        return out

    def _seen(self, codes: np.ndarray) -> np.ndarray:
        """The characters under the kernel at each place: rows, places, width."""
        half = self.WIDTH // 2
        padded = np.pad(codes, ((0, 0), (half, half)))
        return padded[:, np.arange(codes.shape[1])[:, None] + np.arange(self.WIDTH)]

    def _convolved(self, seen: np.ndarray, kernel: np.ndarray, bias: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = self.embed[seen].reshape(*seen.shape[:2], -1)
        return x, np.maximum(x @ kernel + bias, 0)

    def _forward(self, codes: np.ndarray) -> tuple:
        """Everything that ``fit`` needs, the logit last; written for the gradient, not for speed."""
        body = codes[:, self.parts[0]]
        there = (body != 0)[:, :, None]
        length = np.maximum(there.sum(axis=1), 1)
        seen = self._seen(body)
        x, h = self._convolved(seen, self.kernel, self.bias)
        h = h * there
        pooled = np.concatenate([h.max(axis=1), h.sum(axis=1) / length], axis=1)
        sides = []
        for part in (codes[:, :BEFORE], codes[:, BEFORE + BODY_LENGTH :]):
            seen_there = self._seen(part)
            sides.append((seen_there, *self._convolved(seen_there, self.around, self.around_bias)))
        edge = np.concatenate([side[2].max(axis=1) for side in sides], axis=1)
        added = np.tanh(edge @ self.around_out)
        logit = pooled @ self.out + self.out_bias + self.gain * added
        return seen, x, h, there, length, pooled, sides, edge, added, logit

    def _taps(self, kernel: np.ndarray) -> np.ndarray:
        """What each character adds at each place of a kernel."""
        return (self.embed @ kernel.reshape(self.WIDTH, self.SIZE, -1)).astype(np.float32)

    def _pooled(self, codes: np.ndarray, kernel: np.ndarray) -> np.ndarray:
        """The convolution of all rows, by the table of ``_taps``, without bias: rows, places, filters."""
        half, taps = self.WIDTH // 2, self._taps(kernel)
        padded = np.pad(codes, ((0, 0), (half, half)))
        h = taps[0][padded[:, : codes.shape[1]]]
        for k in range(1, self.WIDTH):
            h += taps[k][padded[:, k : k + codes.shape[1]]]
        return h

    def body_logits(self, body: np.ndarray) -> np.ndarray:
        """What candidates (rows of any width, 0 behind their end) say for themselves."""
        out = np.zeros(len(body))
        for i in range(0, len(body), ROWS):
            part = body[i : i + ROWS]
            there = part != 0
            h = np.maximum(self._pooled(part, self.kernel) + self.bias.astype(np.float32), 0) * there[:, :, None]
            mean = h.sum(axis=1) / np.maximum(there.sum(axis=1), 1)[:, None]
            out[i : i + ROWS] = np.concatenate([h.max(axis=1), mean], axis=1) @ self.out + self.out_bias
        return out

    def around_logits(self, before: np.ndarray, after: np.ndarray) -> np.ndarray:
        """What the surroundings add."""
        bias = self.around_bias.astype(np.float32)
        sides = [np.maximum(self._pooled(x, self.around) + bias, 0).max(axis=1) for x in (before, after)]
        return self.gain[0] * np.tanh(np.concatenate(sides, axis=1) @ self.around_out)

    def reach(self) -> float:
        """The most that surroundings can add."""
        return float(abs(self.gain[0]))

    def logits(self, codes: np.ndarray) -> np.ndarray:
        """The output of ``_forward``."""
        body, out = codes[:, self.parts[0]], np.zeros(len(codes))
        for at, width in self._by_width(body):
            out[at] = self.body_logits(body[at, :width])
        for i in range(0, len(codes), ROWS):
            part = codes[i : i + ROWS]
            out[i : i + ROWS] += self.around_logits(part[:, :BEFORE], part[:, BEFORE + BODY_LENGTH :])
        return out

    def calibrated(self, logits: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale[0] * logits + self.scale[1], -30, 30)))

    def scores(self, codes: np.ndarray) -> np.ndarray:
        return self.calibrated(self.logits(codes))

    def fit(self, codes: np.ndarray, labels: np.ndarray, epochs: int = 8, rate: float = RATE, seed: int = 5) -> None:
        """Batches in which the surroundings of every second row are hidden; both labels weigh the same."""
        r, step = np.random.default_rng(seed), Adam(self)
        share = np.where(labels == 1, 0.5 / max(labels.mean(), 1e-9), 0.5 / max(1 - labels.mean(), 1e-9))
        for _ in range(epochs):
            order = r.permutation(len(codes))
            for i in range(0, len(order), 64):
                rows = order[i : i + 64]
                step(self._gradient(self.half_hidden(codes[rows], r), labels[rows], share[rows] / len(rows)), rate)

    def half_hidden(self, codes: np.ndarray, r: np.random.Generator) -> np.ndarray:
        """The same rows, without what stands around every second one."""
        out = codes.copy()
        hide = np.flatnonzero(r.random(len(out)) < 0.5)
        out[hide[:, None], self.parts[1]] = 0
        return out

    def _by_class(self, classes: np.ndarray, back: np.ndarray) -> np.ndarray:
        """Sums of the rows of ``back`` with each class."""
        out = np.zeros((self.CLASSES, back.shape[1]))
        number = np.bincount(classes, minlength=self.CLASSES)
        there = np.flatnonzero(number)
        begins = (np.cumsum(number) - number)[there]
        out[there] = np.add.reduceat(back[np.argsort(classes, kind="stable")], begins, axis=0)
        return out

    def _under(self, codes: np.ndarray) -> np.ndarray:
        """The embedded characters under the kernel at each place, one row per place."""
        half, size = self.WIDTH // 2, self.SIZE
        padded = np.pad(codes, ((0, 0), (half, half)))
        x = np.take(self.embed.astype(np.float32), padded, axis=0).reshape(len(codes), -1)
        steps = (x.strides[0], size * x.itemsize, x.itemsize)
        shape = (len(codes), codes.shape[1], self.WIDTH * size)
        return np.lib.stride_tricks.as_strided(x, shape, steps).reshape(-1, self.WIDTH * size)

    def _to_embedding(self, codes: np.ndarray, back: np.ndarray, kernel: np.ndarray) -> np.ndarray:
        """The gradient of the embedding from that of a convolution at each place."""
        (n, places), half = codes.shape, self.WIDTH // 2
        moved = (back.reshape(n * places, -1) @ kernel.astype(np.float32).T).reshape(n, places, self.WIDTH, self.SIZE)
        at = np.zeros((n, places + 2 * half, self.SIZE), np.float32)
        for k in range(self.WIDTH):
            at[:, k : k + places] += moved[:, :, k]
        padded = np.pad(codes, ((0, 0), (half, half)))
        return self._by_class(padded.reshape(-1), at.reshape(-1, self.SIZE))

    def _gradient(self, codes: np.ndarray, labels: np.ndarray, share: np.ndarray) -> list[np.ndarray]:
        """Of the loss over rows that weigh ``share``.

        Candidates up to each of ``WIDTHS`` are convolved apart, in arrays as wide; surroundings that are hidden are one row.
        """
        body = codes[:, BEFORE : BEFORE + BODY_LENGTH]
        done = [(at, body[at, :w], *self._body(body[at, :w])) for at, w in self._by_width(body)]
        pooled = np.zeros((len(codes), 2 * self.FILTERS))
        for at, *_, mine in done:
            pooled[at] = mine

        around = codes[:, self.parts[1]]
        shown = (around != 0).any(axis=1)
        which = np.where(shown, np.cumsum(shown) - 1, shown.sum())
        around = np.concatenate([around[shown], np.zeros((1, BEFORE + AFTER), around.dtype)])
        sides = (around[:, :BEFORE], around[:, BEFORE:])
        found = [self._side(side) for side in sides]
        edge = np.concatenate([most for _, most in found], axis=1)
        added = np.tanh(edge @ self.around_out)

        logit = pooled @ self.out + self.out_bias + self.gain * added[which]
        error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels) * share
        grads = [np.zeros_like(w) for w in self.weights()]
        embed, kernel, bias, out, out_bias, around_kernel, around_bias, around_out, gain = grads
        for at, part, x, h, top, length, _ in done:
            spread = error[at, None] * self.out
            back = np.repeat((spread[:, self.FILTERS :] / length).astype(np.float32)[:, None], part.shape[1], axis=1)
            back[np.arange(len(at))[:, None], top, np.arange(self.FILTERS)] += spread[:, : self.FILTERS]
            back *= h > 0
            flat = back.reshape(-1, self.FILTERS)
            kernel += x.T @ flat
            bias += np.ones(len(flat), np.float32) @ flat
            embed += self._to_embedding(part, back, self.kernel)
        out += pooled.T @ error
        out_bias += error.sum()

        # All rows whose surroundings are hidden have the same; and only the places of the maxima have a gradient.
        total = np.bincount(which, error, len(around))
        inner = total * self.gain[0] * (1 - added * added)
        slope = inner[:, None] * self.around_out * (edge > 0)
        rows, filters, half = np.arange(len(around))[:, None], np.arange(self.AROUND), self.WIDTH // 2
        taps = np.zeros((self.WIDTH, self.CLASSES * self.AROUND))
        for side, (best, _), back in zip(sides, found, (slope[:, : self.AROUND], slope[:, self.AROUND :]), strict=True):
            padded = np.pad(side, ((0, 0), (half, half)))
            around_bias += back.sum(axis=0)
            for k in range(self.WIDTH):
                at = padded[rows, best + k].astype(np.int64) * self.AROUND + filters
                taps[k] += np.bincount(at.reshape(-1), back.reshape(-1), taps.shape[1])
        by_tap = taps.reshape(self.WIDTH, self.CLASSES, self.AROUND)
        embed += np.einsum("kcf,ksf->cs", by_tap, self.around.reshape(self.WIDTH, self.SIZE, -1))
        around_kernel += np.einsum("cs,kcf->ksf", self.embed, by_tap).reshape(self.around.shape)
        around_out += edge.T @ inner
        gain += (total * added).sum()
        return grads

    @staticmethod
    def _by_width(body: np.ndarray) -> list[tuple[np.ndarray, int]]:
        """Which rows fit into an array of each of ``WIDTHS``."""
        wide = sum((body[:, w:] != 0).any(axis=1).astype(np.int64) for w in WIDTHS[:-1])
        return [(at, w) for k, w in enumerate(WIDTHS) if len(at := np.flatnonzero(wide == k))]

    def _body(self, body: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of the convolution of candidates: what is under the kernel, the result, its maxima's places, lengths, and what is pooled."""
        x = self._under(body)
        h = x @ self.kernel.astype(np.float32)
        h += self.bias.astype(np.float32)
        np.maximum(h, 0, out=h)
        there = body != 0
        h = h.reshape(*body.shape, -1)
        h *= there[:, :, None]
        length = np.maximum(there.sum(axis=1), 1)[:, None]
        top = h.argmax(axis=1)
        most = h[np.arange(len(body))[:, None], top, np.arange(self.FILTERS)]
        return x, h, top, length, np.concatenate([most, h.sum(axis=1) / length], axis=1)

    def _side(self, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the maxima of the convolution of one side, and the maxima."""
        h = (self._under(side) @ self.around.astype(np.float32)).reshape(*side.shape, -1)
        best = h.argmax(axis=1)
        most = h[np.arange(len(side))[:, None], best, np.arange(self.AROUND)]
        return best, np.maximum(most + self.around_bias, 0)

    def calibrate(self, codes: np.ndarray, labels: np.ndarray) -> None:
        self.calibrate_on(self.logits(codes), labels, np.ones(len(codes)))

    def calibrate_on(self, logit: np.ndarray, labels: np.ndarray, number: np.ndarray) -> None:
        """Platt scaling: slope and offset of logits that occur ``number`` times, by Newton's method."""
        at, ones, zeros = np.array([1.0, 0.0]), (number * labels).sum(), (number * (1 - labels)).sum()
        # Smoothed labels keep the slope finite where the classes are apart.
        goal = np.where(labels > 0, (ones + 1) / (ones + 2), 1 / (zeros + 2))
        x = np.stack([logit, np.ones(len(logit))], axis=1)
        for _ in range(20):
            p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
            hessian = (x * (number * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
            at = at - np.clip(np.linalg.solve(hessian, x.T @ (number * (p - goal))), -5, 5)
        self.scale = at

    def packed(self) -> np.ndarray:
        return np.concatenate([w.reshape(-1) for w in self.weights()])

    def unpack(self, flat: np.ndarray) -> CharNet:
        at = 0
        for w in self.weights():
            w[...] = flat[at : at + w.size].reshape(w.shape)
            at += w.size
        return self


class Adam:
    """Steps of Adam on the weights of a network."""

    def __init__(self, net: CharNet) -> None:
        self.weights, self.steps = net.weights(), 0
        self.first, self.second = ([np.zeros_like(w) for w in self.weights] for _ in range(2))

    def __call__(self, grads: list[np.ndarray], rate: float) -> None:
        self.steps += 1
        for w, g, m, v in zip(self.weights, grads, self.first, self.second, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= rate * (m / (1 - 0.9**self.steps)) / (np.sqrt(v / (1 - 0.99**self.steps)) + 1e-8)


def spelt_anew(kind: str, seed: bytes) -> str:
    """A value of a kind of ``SPELLINGS``, from a hash of the seed: the shape of a secret and nothing of its text."""
    prefix, alphabet, shortest, longest = SPELLINGS[kind]
    drawn = hashlib.shake_256(kind.encode() + seed).digest(longest + 10)
    length = shortest + drawn[0] % (longest - shortest + 1)
    start = "".join(chr(97 + b % 26) for b in drawn[2 : 4 + drawn[1] % 4]) + "_" if prefix else ""
    return start + "".join(alphabet[b % len(alphabet)] for b in drawn[10 : 10 + length])


def variants(codes: np.ndarray, labels: np.ndarray, kinds: list[str]) -> list[np.ndarray]:
    """For each kind ``VARIANTS`` windows: secrets spelt anew, in the surroundings of other runs.

    The keyword that led a pattern to a secret does not stand there, so that it is the shape that counts.
    """
    secrets, others = codes[labels == 1], codes[labels == 0]
    out = []
    for kind in kinds:
        seeds = [secrets[i % len(secrets), BEFORE : BEFORE + BODY_LENGTH].tobytes() + bytes([i // len(secrets) % 256]) for i in range(VARIANTS)]
        bodies = [spelt_anew(kind, seed)[:BODY_LENGTH] for seed in seeds]
        made = others[[int.from_bytes(hashlib.md5(b.encode()).digest()[:4], "big") % len(others) for b in bodies]].copy()
        made[:, BEFORE : BEFORE + BODY_LENGTH] = encode([b.ljust(BODY_LENGTH, "\0") for b in bodies])
        out.append(made)
    return out


def train(windows: list[str], labels: list[int], left_out: tuple[str, ...] = ()) -> tuple[CharNet, float] | None:
    """Network and threshold from labelled findings; None if a label is missing.  Kinds may be ``left_out``."""
    return train_on(encode(windows), np.array(labels, dtype=float), left_out)


def train_on(codes: np.ndarray, y: np.ndarray, left_out: tuple[str, ...] = ()) -> tuple[CharNet, float] | None:
    held = _held(codes)
    if any(len(np.unique(part)) < 2 for part in (y[held], y[~held])):
        return None
    kinds = [kind for kind in SPELLINGS if kind not in left_out]
    made = variants(codes, y, kinds)
    apart = [_held(m) for m in made]
    ones = lambda parts: [np.ones(len(p)) for p in parts]
    fitted = [m[~h] for m, h in zip(made, apart, strict=True)]
    checked = [m[h] for m, h in zip(made, apart, strict=True)]
    net = CharNet()
    net.fit(np.concatenate([codes[~held], *fitted]), np.concatenate([y[~held], *ones(fitted)]))
    net.calibrate(np.concatenate([codes[held], *checked]), np.concatenate([y[held], *ones(checked)]))
    shown = codes[held][y[held] == 1]
    found = [_threshold(net.scores(x), RECALL) for x in (shown, net.alone(shown))]
    return net, min(*found, *(_threshold(net.scores(x), RECALL_OF_KINDS) for x in checked if len(x)))


def _held(codes: np.ndarray) -> np.ndarray:
    """About a quarter of the rows, by a hash of what they show."""
    return np.array([hashlib.md5(row.astype(np.uint8).tobytes()).digest()[0] % 4 == 0 for row in codes], dtype=bool)


def _threshold(scores: np.ndarray, recall: float) -> float:
    """The highest one that the share ``recall`` of the scores reach."""
    return float(np.sort(scores)[int((1 - recall) * len(scores))])


# --- Spark ----------------------------------------------------------------------------------------

_FOUND = "array<struct<start:int,kind:int,end:int>>"


def secret_windows(docs: DataFrame) -> DataFrame:
    """hash and codes of all distinct windows that the patterns take for secrets."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = batch.column("text").fill_null("").to_pylist()
            matched = [(t, found) for t in texts if (found := base_spans(t))[0]]
            if matched:
                runs = Runs(*map(list, zip(*matched, strict=True)))
                values = np.array(runs.values, np.int64).reshape(-1, 2)
                starts, ends = np.append(runs.starts[runs.touched], values[:, 0]), np.append(runs.ends[runs.touched], values[:, 1])
                for codes in runs.shown(starts, ends):
                    yield pa.RecordBatch.from_arrays([pa.array(list(map(bytes, codes)), pa.binary())], names=["codes"])

    found = docs.select("text").mapInArrow(find, "codes binary").distinct()
    return found.select(F.xxhash64("codes").alias("hash"), "codes")


def _other_codes(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """The windows of all runs that touch no pattern's match."""
    texts = batch.column("text").fill_null("").to_pylist()
    runs = Runs(texts, [base_spans(t) for t in texts])
    return runs.shown(runs.starts[~runs.touched], runs.ends[~runs.touched])


def _chunks(found: Iterator[np.ndarray], size: int) -> Iterator[np.ndarray]:
    """The same rows, ``size`` at once."""
    kept: list[np.ndarray] = []
    for codes in found:
        kept.append(codes)
        if sum(map(len, kept)) >= size:
            rows = np.concatenate(kept)
            whole = len(rows) // size * size
            yield from (rows[i : i + size] for i in range(0, whole, size))
            kept = [rows[whole:]]
    rows = np.concatenate(kept) if kept else np.zeros((0, LENGTH), np.uint8)
    if len(rows):
        yield rows


def teach(net: CharNet, others: Iterator[np.ndarray], secrets: np.ndarray, seed: int, last: int = 0) -> int:
    """One step for every ``STEP`` of others, with secrets in turn; both labels weigh the same.

    The rate falls over ``last`` rows, or is that of later shards.  Returns how many others there were.
    """
    r, step, turns, shown = np.random.default_rng(seed), Adam(net), np.zeros(0, np.int64), 0
    for chunk in others:
        order = r.permutation(len(chunk))
        for i in range(0, len(order), STEP[0]):
            rows = order[i : i + STEP[0]]
            while len(turns) < STEP[1]:
                turns = np.append(turns, r.permutation(len(secrets)))
            mine, turns = turns[: STEP[1]], turns[STEP[1] :]
            labels = np.repeat([0.0, 1.0], [len(rows), len(mine)])
            share = np.repeat([0.5 / len(rows), 0.5 / len(mine)], [len(rows), len(mine)])
            codes = net.half_hidden(np.concatenate([chunk[rows], secrets[mine]]), r)
            rate = LATER_RATE + (RATE - LATER_RATE) * max(0.0, 1 - shown / last) if last else LATER_RATE
            step(net._gradient(codes, labels, share), rate)
            shown += len(rows)
    return shown


def _fitted(shard: int, parts: Iterator[pa.RecordBatch], start: np.ndarray | None) -> tuple[CharNet, int, list[np.ndarray]] | None:
    """The network that a shard teaches, by how many other runs, and the made windows of each kind that are held back."""
    secrets: list[np.ndarray] = []

    def texts() -> Iterator[np.ndarray]:
        last = None
        for part in parts:
            shown = b"".join(part.column("codes").drop_null().to_pylist())
            secrets.append(np.frombuffer(shown, np.uint8).reshape(-1, LENGTH))
            part = part.filter(part.column("text").is_valid())
            hashed = part.column("hash").to_numpy()
            new = np.append(hashed[:1] != last, hashed[1:] != hashed[:-1])
            last = hashed[-1] if len(hashed) else last
            for batch in slices(iter([part.filter(pa.array(new, pa.bool_()))]), "text"):
                yield from _other_codes(batch)

    # The secrets of a shard stand before its texts.
    chunks = _chunks(texts(), SHUFFLED)
    begun = next(chunks, None)
    known = np.concatenate(secrets) if secrets else np.zeros((0, LENGTH), np.uint8)
    if begun is None or not len(known):
        return None
    net = CharNet()
    labels = np.repeat([1.0, 0.0], [len(known), len(begun)])
    made = variants(np.concatenate([known, begun]), labels, list(SPELLINGS))
    apart = [_held(m) for m in made]
    positive = np.concatenate([known, *(m[~h] for m, h in zip(made, apart, strict=True))])
    if start is None:
        whole = [begun, *chunks]
        n = sum(map(len, whole))
        # Over and over if they are few.
        epochs = min(-(-SHOWN // n), 2 * SHOWN // STEP[0])
        again = itertools.chain.from_iterable(itertools.repeat(whole, epochs))
        teach(net, again, positive, shard, epochs * n)
    else:
        n = teach(net.unpack(start), itertools.chain([begun], chunks), positive, shard)
    return net, n, [m[h] for m, h in zip(made, apart, strict=True)]


def _by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[pa.RecordBatch]]]:
    def parts() -> Iterator[tuple[int, pa.RecordBatch]]:
        for batch in batches:
            shard = batch.column("shard").to_numpy()
            cuts = np.flatnonzero(np.diff(shard)) + 1
            for a, b in itertools.pairwise([0, *cuts.tolist(), len(shard)]):
                if b > a:
                    yield int(shard[a]), batch.slice(a, b - a)

    for shard, rows in itertools.groupby(parts(), key=lambda x: x[0]):
        yield shard, (batch for _, batch in rows)


def _first_network(rows: DataFrame) -> tuple[np.ndarray, int, list[np.ndarray]] | None:
    """Weights that the first shard teaches, its number of other runs, and made windows that are held back."""

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, parts in _by_shard(batches):
            if fitted := _fitted(shard, parts, None):
                net, n, made = fitted
                weights = pa.array([net.packed().tolist()], pa.list_(pa.float64()))
                checked = pa.array([[m.tobytes() for m in made]], pa.list_(pa.binary()))
                yield pa.RecordBatch.from_arrays([weights, pa.array([n]), checked], names=["weights", "n", "made"])

    row = rows.mapInArrow(fit, "weights array<double>, n long, made array<binary>").first()
    if row is None:
        return None
    made = [np.frombuffer(bytes(m), np.uint8).reshape(-1, LENGTH) for m in row["made"]]
    return np.array(row["weights"]), row["n"], made


def _mean_network(rows: DataFrame, start: np.ndarray) -> tuple[np.ndarray, int]:
    """The mean of the weights that shards come to from ``start``, by their numbers of runs, and the sum of these."""
    sent, unit = rows.sparkSession.sparkContext.broadcast(start), float(1 << 24)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, parts in _by_shard(batches):
            if fitted := _fitted(shard, parts, sent.value):
                net, n, _ = fitted
                # Whole numbers add up to the same sum in any order.
                values = np.append(np.rint(net.packed() * unit).astype(np.int64), 1) * n
                places = pa.array(np.arange(len(values)), pa.int32())
                yield pa.RecordBatch.from_arrays([places, pa.array(values)], names=["place", "value"])

    sums = rows.mapInArrow(fit, "place int, value long").groupBy("place").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    found = {r["place"]: int(r["value"]) for r in sums.collect()}
    if not found:
        return start, 0
    return np.array([found[k] / found[len(start)] / unit for k in range(len(start))]), found[len(start)]


def _binned(logits: np.ndarray) -> np.ndarray:
    return np.floor(np.clip(logits, -100, 100) * STEPS).astype(np.int64)


def _counted(bins: np.ndarray, group: int) -> pa.RecordBatch:
    at, number = np.unique(bins, return_counts=True)
    columns = [pa.array(np.full(len(at), group), pa.int32()), pa.array(at), pa.array(number.astype(np.int64))]
    return pa.RecordBatch.from_arrays(columns, names=["group", "bin", "number"])


def _held_logits(secrets: DataFrame, texts: DataFrame, net: CharNet) -> list[tuple[np.ndarray, np.ndarray]]:
    """Bins of logits and their counts: of other runs, of secrets, of secrets without their surroundings."""
    sent = texts.sparkSession.sparkContext.broadcast(net)

    def of_others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            bins = [_binned(sent.value.logits(codes)) for codes in _other_codes(batch)]
            yield _counted(np.concatenate(bins) if bins else np.zeros(0, np.int64), 0)

    def of_secrets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.frombuffer(b"".join(batch.column("codes").to_pylist()), np.uint8).reshape(-1, LENGTH)
            yield _counted(_binned(sent.value.logits(codes)), 1)
            yield _counted(_binned(sent.value.logits(sent.value.alone(codes))), 2)

    schema = "group int, bin long, number long"
    each = texts.select("text").mapInArrow(of_others, schema).unionAll(secrets.select("codes").mapInArrow(of_secrets, schema))
    rows = each.groupBy("group", "bin").agg(F.sum("number").alias("number")).collect()
    out = []
    for group in range(3):
        mine = sorted((r["bin"], r["number"]) for r in rows if r["group"] == group)
        out.append((np.array([b for b, _ in mine], float), np.array([n for _, n in mine], float)))
    return out


def _fitted_network(secrets: DataFrame, texts: DataFrame) -> tuple[CharNet, int, list[np.ndarray]] | None:
    """A network that all these secrets and all other runs of the texts have taught, and as ``_fitted``."""
    size, known = texts.agg(F.sum(F.octet_length("text").cast("long")).alias("n")).first()["n"], secrets.count()
    if not size or not known:
        return None
    shards = -(-size // SHARD_BYTES)
    copies = min(shards, -(-SECRETS * shards // known))
    # The lowest bits of a hash tell what is held back.
    shard = F.pmod(F.shiftright("hash", 2), F.lit(shards))
    every = F.transform(F.sequence(F.lit(0), F.lit(copies - 1)), lambda k: F.pmod(shard + k, F.lit(shards)))
    rows = secrets.select(F.explode(every).alias("shard"), "hash", "codes", F.lit(None).cast("string").alias("text"))
    rows = rows.unionAll(texts.select(shard.alias("shard"), "hash", F.lit(None).cast("binary").alias("codes"), "text"))
    order = ("shard", F.col("text").isNotNull(), "hash", "text", "codes")
    begun = _first_network(rows.where(F.col("shard") == 0).repartition(1).sortWithinPartitions(*order))
    if begun is None or shards == 1:
        return begun and (CharNet().unpack(begun[0]), *begun[1:])
    weights, n, made = begun
    rest = rows.where(F.col("shard") > 0).repartitionById(shards - 1, (F.col("shard") - 1).cast("int")).sortWithinPartitions(*order)
    weights, more = _mean_network(rest, weights)
    return CharNet().unpack(weights), n + more, made


def findings(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Windows of secrets and texts, each with a hash."""
    texts = docs.select(F.xxhash64("text").alias("hash"), "text").where(F.col("text") != "")
    return saved(secret_windows(docs)), texts


def learn(docs: DataFrame) -> tuple[CharNet, float] | None:
    """Train on the labelled findings of all documents: three quarters fit the network, a quarter sets the threshold."""
    secrets, texts = findings(docs)
    held = F.pmod("hash", F.lit(4)) == 0
    fitted = _fitted_network(secrets.where(~held), texts.where(~held))
    if fitted is None:
        return None
    net, _, made = fitted
    others, shown, alone = _held_logits(secrets.where(held), texts.where(held), net)
    if not len(others[0]) or not len(shown[0]):
        return None
    spelt = [net.logits(m) for m in made if len(m)]
    middle = (np.concatenate([others[0], shown[0]]) + 0.5) / STEPS
    logits = np.concatenate([middle, *spelt])
    number = np.append(np.concatenate([others[1], shown[1]]), np.ones(len(logits) - len(middle)))
    net.calibrate_on(logits, (np.arange(len(logits)) >= len(others[0])).astype(float), number)

    def scores(bins: np.ndarray) -> np.ndarray:
        """Of the lower end of each step, so that the recall is reached."""
        return net.calibrated((bins + (net.scale[0] < 0)) / STEPS)

    found = [_threshold(np.repeat(scores(b), n.astype(np.int64)), RECALL) for b, n in (shown, alone)]
    return net, min(*found, *(_threshold(net.calibrated(x), RECALL_OF_KINDS) for x in spelt))


def model_spans(
    texts: list[str], open_ones: list[tuple[int, int, int]], model: tuple[CharNet, float] | None
) -> list[tuple[int, int, int]]:
    """Those of (text, start, end) that the network takes for secrets, by their best window."""
    if model is None:
        return []
    net, threshold = model
    out: list[tuple[int, int, int]] = []
    seen: list[str] = []
    of: list[tuple[int, int, int]] = []

    def score() -> None:
        hits = np.flatnonzero(net.scores(encode(seen)) >= threshold)
        out.extend(dict.fromkeys(of[h] for h in hits))
        seen.clear()
        of.clear()

    for one in open_ones:
        shown = windows(texts[one[0]], one[1], one[2])
        for at in range(0, len(shown), BATCH):
            part = shown[at : at + BATCH]
            seen += part
            of += [one] * len(part)
            if len(seen) >= BATCH:
                score()
    if seen:
        score()
    return list(dict.fromkeys(out))


def spans_in(texts: list[str], model: tuple[CharNet, float] | None) -> tuple[list[list[Span]], list[list[Span]]]:
    """For each text the spans of the patterns, and those of the network."""
    found = [base_spans(t) for t in texts]
    added: list[list[Span]] = [[] for _ in texts]
    for row, start, end in Runs(texts, found).secret(*model) if model else ():
        added[row].append(Span(start, len(KINDS) - 1, end))
    return [base for base, _ in found], added


def all_spans(docs: DataFrame, model: tuple[CharNet, float] | None) -> DataFrame:
    """doc_id, base (spans of the patterns) and spans (with the network's), both in order."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    kind = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            base, added = spans_in(batch.column("text").fill_null("").to_pylist(), sent.value)
            both = [sorted(b + a) for b, a in zip(base, added, strict=True)]
            columns = [pa.array([[s._asdict() for s in row] for row in rows], kind) for rows in (base, both)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=["doc_id", "base", "spans"])

    return docs.select("doc_id", "text").mapInArrow(add, f"doc_id {id_type}, base {_FOUND}, spans {_FOUND}")


def _joined(spans: str) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    text = F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"]))
    return F.array_join(text, ",")


def _number_of(spans: str, kind: int) -> Column:
    # One parameter only: Spark would give a second one the place of the element.
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def report(docs: DataFrame) -> DataFrame:
    found = all_spans(docs, learn(docs))
    return found.select(
        "doc_id",
        *(_number_of("base", k).alias(f"n_{KINDS[k]}") for k in range(3)),
        F.sha2(_joined("base"), 256).alias("base_sha256"),
        _joined("spans").alias("spans"),
    )


def redacted(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """The input's rows with every span replaced by ``mark``; n_chars, if there is one, follows."""
    model = learn(docs)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.schema

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = batch.column("text").to_pylist()
            base, added = spans_in([t or "" for t in texts], sent.value)
            spans = [[(x.start, x.end) for x in b + a] for b, a in zip(base, added, strict=True)]
            out = [_cut(t, s, mark) if s else t for t, s in zip(texts, spans, strict=True)]
            columns = []
            for name in batch.schema.names:
                if name == "text":
                    columns.append(pa.array(out, batch.column("text").type))
                elif name == "n_chars":
                    sizes = [
                        len(t) if s else n
                        for t, s, n in zip(out, spans, batch.column("n_chars").to_pylist(), strict=True)
                    ]
                    columns.append(pa.array(sizes, batch.column("n_chars").type))
                else:
                    columns.append(batch.column(name))
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.mapInArrow(clean, schema)


def _cut(text: str, spans: list[tuple[int, int]], mark: str) -> str:
    """``text`` with each maximal run of overlapping spans replaced by ``mark``."""
    out, at = [], 0
    for start, end in sorted(spans):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])
