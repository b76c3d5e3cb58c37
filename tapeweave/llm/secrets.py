"""Secret scan: fixed patterns, and a character convolution network over everything else that looks like a token.

One pass over the texts yields the findings of the patterns and, with their
surroundings, every other candidate: runs of ``CANDIDATE`` or more token
characters that hold a digit, a sign or a capital inside, and runs of ``LONG``
or more of any kind (shorter ones without are plain words). Only a run that lies
wholly inside a finding is left out. The network is trained in numpy on all
distinct windows of both and on a fixed set of examples, which is there at every
size; pattern findings are the labelled secrets, and half of them are shown
without their own surroundings, so that the network learns what a secret looks
like and not only the word before it. Long tokens as even as random ones are no
examples of harmless text, since some are secrets that nobody has labelled.

Windows are dealt to shards by their hash. In each of a few rounds every shard
trains the common network on all of its windows, and the mean of the shards'
networks is the next common one. A fifth of the windows is held out: the scores
are calibrated on all of these, and the threshold is the highest one that still
finds a given share of all held-out secrets, and of the fixed ones among them.
The driver holds a network and a count of each possible output.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeweave.llm.common import saved, with_column

# The base patterns and their order.
KINDS = ("assign", "access", "hex", "network")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
LEAST = {"assign": 6, "access": 20, "hex": 24}
CANDIDATE = 6
LONG = 16
EXAMPLES = 900  # fixed examples of each label
EVEN = 3.6  # bits a character, from which a token of ``LONG`` or more counts as random

RATES = (0.01, 0.005, 0.0025)  # step lengths of the rounds
STEPS = 600  # of all rounds together, at least
HALF = 64  # windows of each label in a step
SHARD = HALF * STEPS // len(RATES) // 2  # windows of the more frequent label in a shard, about: each is taken once a round
GRAIN, EDGE = 256, 64  # outputs are whole multiples of 1 / GRAIN from -EDGE to EDGE, so they can be counted
POINT = 1 << 32  # networks are added up in fixed point, so their mean doesn't depend on the order
RECALL = 0.98
LEFT, BODY, RIGHT = 24, 48, 8
WIDTH = LEFT + BODY + RIGHT
GROUP_BYTES = 1 << 20
FINDING = "array<struct<kind:string,start:int,end:int,score:double>>"

_HEX, _TOKEN, _DIGIT, _CAPITAL = (np.zeros(256, bool) for _ in range(4))
_HEX[list(b"0123456789abcdef")] = True
_TOKEN[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")] = True
_DIGIT[list(b"0123456789+/_=")] = True
_CAPITAL[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")] = True


def base(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the patterns' matches: leftmost, not overlapping within a kind, long enough."""
    return _base(text, [(m.start(), m.end()) for m in re.finditer("[0-9a-f]{24,}", text)])


def _base(text: str, hexes: list[tuple[int, int]]) -> list[tuple[str, int, int]]:
    low = text.lower()
    out = []
    if any(w in low for w in _WORDS):
        out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    out += [("hex", a, b) for a, b in hexes]
    return sorted(out, key=lambda f: (f[1], KINDS.index(f[0])))


def _runs(mask: np.ndarray, least: int) -> np.ndarray:
    """(start, end) of runs of at least ``least``."""
    edge = np.diff(np.concatenate([[0], mask.view(np.int8), [0]]))
    found = np.stack([np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)], 1)
    return found[found[:, 1] - found[:, 0] >= least]


def scan(texts: list[str | None]) -> Iterator[tuple[list[tuple[str, int, int]], list[tuple[int, int]]]]:
    """Base findings and other candidates (start, end) of each text, in code points."""
    run, size = [], 0
    for t in texts:
        run.append((t or "", (t or "").encode("utf-8", "surrogatepass")))
        size += len(run[-1][1])
        if size >= GROUP_BYTES:
            yield from _scan(run)
            run, size = [], 0
    yield from _scan(run)


def _scan(run):
    if not run:
        return
    data = np.frombuffer(b"\n".join(b for _, b in run) + b"\n", np.uint8)
    edge = np.cumsum([0, *(len(b) + 1 for _, b in run)])
    hexes = _runs(_HEX[data], LEAST["hex"])
    tokens = _runs(_TOKEN[data], CANDIDATE)
    digits = np.concatenate([[0], np.cumsum(_DIGIT[data])])
    capitals = np.concatenate([[0], np.cumsum(_CAPITAL[data])])
    signs = digits[tokens[:, 1]] - digits[tokens[:, 0]]
    inner = capitals[tokens[:, 1]] - capitals[tokens[:, 0] + 1]
    tokens = tokens[(signs > 0) | (inner > 0) | (tokens[:, 1] - tokens[:, 0] >= LONG)]
    of_hex, of_token = (np.searchsorted(x[:, 0], edge) for x in (hexes, tokens))
    for d, (text, raw) in enumerate(run):
        def places(found: np.ndarray) -> list[tuple[int, int]]:
            at = (found - edge[d]).tolist()
            if len(raw) == len(text):
                return [tuple(x) for x in at]
            return [(s := len(raw[:a].decode("utf-8", "surrogatepass")), s + b - a) for a, b in at]  # tokens are ASCII

        h, t = hexes[of_hex[d]:of_hex[d + 1]], tokens[of_token[d]:of_token[d + 1]]
        found = _base(text, places(h) if len(h) else [])
        other = [(a, b) for a, b in (places(t) if len(t) else []) if not any(s <= a and b <= e for _, s, e in found)]
        yield found, other


def windows(text: str, start: int, end: int) -> list[str]:
    """What the network sees of a token: pieces of ``BODY`` characters with their surroundings, ``WIDTH`` each."""
    out = []
    for a in range(start, end, BODY):
        b = min(a + BODY, end)
        out.append(text[max(0, a - LEFT):a].rjust(LEFT, "\0") + text[a:b].ljust(BODY, "\0")
                   + text[b:b + RIGHT].ljust(RIGHT, "\0"))
    return out


def random_like(token: str) -> bool:
    """Whether a long token spreads over its characters as evenly as random ones do."""
    if len(token) < LONG:
        return False
    counts = np.unique(np.frombuffer(token.encode("utf-32-le", "surrogatepass"), np.uint32), return_counts=True)[1] / len(token)
    return float(-(counts * np.log2(counts)).sum()) >= min(EVEN, np.log2(len(token)) - 0.4)


def examples(seed: int = 17) -> tuple[list[str], list[str]]:
    """Fixed windows of secrets (random tokens) and of harmless ones (words, numbers, dates, paths, names)."""
    rng = np.random.default_rng(seed)
    letters, lower, digits, hexes = ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", "abcdefghijklmnopqrstuvwxyz", "0123456789", "0123456789abcdef")

    def text(kind: str, low: int, high: int) -> str:
        return "".join(kind[i] for i in rng.integers(0, len(kind), rng.integers(low, high + 1)))

    def word() -> str:
        return "".join(("bcdfglmnprst"[rng.integers(12)] + "aeiou"[rng.integers(5)]) for _ in range(rng.integers(2, 5)))

    secret = [lambda: text(letters + digits, 20, 44), lambda: text(hexes, 24, 64), lambda: "AKIA" + text(letters[:26] + digits, 16, 16),
              lambda: text(letters + digits + "+/", 30, 48) + "==", lambda: text(letters + digits, 10, 18), lambda: text(letters + digits, 12, 40)]
    plain = [lambda: f"{text(digits, 4, 4)}-{text(digits, 2, 2)}-{text(digits, 2, 2)}", lambda: text(digits, 6, 12), lambda: text(digits, 8, 28),
             lambda: "/".join(word() for _ in range(3)), lambda: word() + word().capitalize(), lambda: f"{word()}_{word()}.py",
             lambda: f"{word()}={text(digits, 1, 3)}", lambda: word() + word() + word() + word(), lambda: f"{word()}-{word()}-{text(digits, 1, 4)}",
             lambda: f"www.{word()}.com/{word()}"]
    out: list[list[str]] = []
    for made in (secret, plain):
        rows = []
        for i in range(EXAMPLES):
            beside = word if i % 2 else lambda: text(lower, 2, 9)
            before, token, after = " ".join(beside() for _ in range(4)) + " ", made[i % len(made)](), " " + beside()
            rows.append(windows(before + token + after, len(before), len(before) + len(token))[0])
        out.append(rows)
    return out[0], out[1]


def codes(found: list[str]) -> np.ndarray:
    """Printable ASCII as 1 to 95, other characters as 96, nothing as 0."""
    c = np.frombuffer("".join(found).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, WIDTH).astype(np.int64)
    return np.where(c == 0, 0, np.where((c >= 32) & (c < 127), c - 31, 96))


@dataclass
class Network:
    """Embedding, one convolution, maxima over the places, one logistic unit; then calibration."""

    embed: np.ndarray
    conv: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    scale: tuple[float, float] = (1.0, 0.0)
    threshold: float = 2.0  # nothing, until it is trained
    trained: tuple[int, int] = (0, 0)  # windows of each label, secrets first, without the fixed ones
    held: tuple[int, int] = (0, 0)

    SPAN = 5

    def _forward(self, x: np.ndarray):
        e = self.embed[x]
        seen = np.lib.stride_tricks.sliding_window_view(e, self.SPAN, axis=1)  # n, places, depth, span
        seen = seen.reshape(len(x), seen.shape[1], -1)
        h = np.maximum(seen @ self.conv + self.bias, 0)
        best = h.argmax(1)
        top = np.take_along_axis(h, best[:, None], 1)[:, 0]
        return seen, best, top, top @ self.out[:-1] + self.out[-1]

    def grains(self, x: np.ndarray) -> np.ndarray:
        """The outputs before calibration, in whole multiples of 1 / ``GRAIN``."""
        parts = [self._forward(x[i:i + 512])[3] for i in range(0, len(x), 512)]
        return np.rint(np.clip(np.concatenate([*parts, np.zeros(0)]), -EDGE, EDGE) * GRAIN).astype(np.int64)

    def calibrated(self, grains: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale[0] * (grains / GRAIN) + self.scale[1], -40, 40)))

    def score(self, x: np.ndarray) -> np.ndarray:
        return self.calibrated(self.grains(x))

    def flat(self) -> np.ndarray:
        """All that is learned, in fixed point."""
        return np.rint(np.concatenate([p.ravel() for p in (self.embed, self.conv, self.bias, self.out)]) * POINT).astype(np.int64)

    def with_flat(self, values: np.ndarray) -> Network:
        shapes = [p.shape for p in (self.embed, self.conv, self.bias, self.out)]
        cut = np.split(values / POINT, np.cumsum([int(np.prod(n)) for n in shapes])[:-1])
        return Network(*(p.reshape(n) for p, n in zip(cut, shapes)))


@dataclass
class Shown:
    """Codes of windows of both labels, those that train and those held out."""

    good: np.ndarray
    bad: np.ndarray
    held_good: np.ndarray
    held_bad: np.ndarray

    @classmethod
    def of(cls, secrets: list[str], others: list[str]) -> Shown:
        """A fifth of each is held out."""
        good, bad = codes(secrets), codes(others)
        held_good, held_bad = np.arange(len(good)) % 5 == 0, np.arange(len(bad)) % 5 == 0
        return cls(good[~held_good], bad[~held_bad], good[held_good], bad[held_bad])

    def __add__(self, other: Shown) -> Shown:
        return Shown(*(np.concatenate([getattr(self, f), getattr(other, f)]) for f in ("good", "bad", "held_good", "held_bad")))

    def counts(self, net: Network, others: np.ndarray, seed: int) -> list[tuple[bool, int, int]]:
        """(secret, output, number) of the held-out windows."""
        return _counted(net.grains(_bare(self.held_good, others, np.random.default_rng(seed))), net.grains(self.held_bad))


def start(rng: np.random.Generator) -> Network:
    depth, filters = 8, 24
    return Network(rng.normal(0, 0.3, (97, depth)), rng.normal(0, 0.15, (depth * Network.SPAN, filters)),
                   np.zeros(filters), rng.normal(0, 0.1, filters + 1))


def _bare(x: np.ndarray, others: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Half of the secrets in the surroundings of others."""
    x = x.copy()
    swap = np.flatnonzero(rng.random(len(x)) < 0.5)
    x[swap, :LEFT] = others[rng.integers(0, len(others), len(swap)), :LEFT]
    return x


def _counted(good: np.ndarray, bad: np.ndarray) -> list[tuple[bool, int, int]]:
    """(secret, output, number) of outputs in grains."""
    return [(secret, z, n) for secret, x in ((True, good), (False, bad))
            for z, n in zip(*(v.tolist() for v in np.unique(x, return_counts=True)))]


class _Steps:
    """Steps of gradient descent on one network, with Adam's moments."""

    def __init__(self, net: Network, rate: float):
        self.net, self.rate, self.done = net, rate, 0
        self.moments = [[np.zeros_like(p), np.zeros_like(p)] for p in (net.embed, net.conv, net.bias, net.out)]

    def take(self, good: np.ndarray, bad: np.ndarray) -> None:
        net, (depth, filters) = self.net, (self.net.embed.shape[1], len(self.net.bias))
        self.done += 1
        x, y = np.concatenate([good, bad]), np.repeat([1.0, 0.0], [len(good), len(bad)])
        seen, best, top, z = net._forward(x)
        dz = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y) / len(y)
        d_out = np.append(dz @ top, dz.sum())
        d_top = dz[:, None] * net.out[:-1] * (top > 0)
        picked = seen[np.arange(len(x))[:, None], best]  # n, filters, inputs
        d_conv = np.einsum("nf,nfi->if", d_top, picked)
        d_in = (d_top[:, :, None] * net.conv.T[None]).reshape(len(x), filters, depth, Network.SPAN)
        d_embed = np.zeros_like(net.embed)
        for k in range(Network.SPAN):
            np.add.at(d_embed, np.take_along_axis(x, best + k, 1), d_in[..., k])
        for p, g, m in zip((net.embed, net.conv, net.bias, net.out), (d_embed, d_conv, d_top.sum(0), d_out), self.moments):
            m[0] = 0.9 * m[0] + 0.1 * g
            m[1] = 0.999 * m[1] + 0.001 * g * g
            p -= self.rate * (m[0] / (1 - 0.9 ** self.done)) / (np.sqrt(m[1] / (1 - 0.999 ** self.done)) + 1e-8)


def _turns(own: int, fixed: int, steps: int, rng: np.random.Generator) -> np.ndarray:
    """Places of the windows of one label by step: each once before any comes again; at least half are ``fixed`` ones, which come first."""
    pool = np.concatenate([*[np.arange(fixed)] * max(1, -(-own // fixed)), fixed + np.arange(own)])
    steps = max(steps, -(-len(pool) // HALF))
    return np.concatenate([rng.permutation(pool) for _ in range(-(-steps * HALF // len(pool)))])[:steps * HALF].reshape(steps, HALF)


def train(net: Network, own: Shown, fixed: Shown, steps: int, rate: float, seed: int) -> Network:
    """``net`` after ``steps``, and as many more as it takes to see every training window of ``own`` once; the mean of the later half."""
    rng = np.random.default_rng(seed)
    run, shown = _Steps(net.with_flat(net.flat()), rate), fixed + own
    of_good, of_bad = _turns(len(own.good), len(fixed.good), steps, rng), _turns(len(own.bad), len(fixed.bad), steps, rng)
    steps = max(len(of_good), len(of_bad))
    later = []
    for step in range(steps):
        run.take(_bare(shown.good[of_good[step % len(of_good)]], shown.bad, rng), shown.bad[of_bad[step % len(of_bad)]])
        if step >= steps // 2:
            later.append(run.net.flat())
    return net.with_flat(np.mean(later, 0))


def _lowest(counts: list[tuple[bool, int, int]], recall: float) -> int:
    """The highest output that at least ``recall`` of the secrets reach."""
    found = sorted((z, n) for secret, z, n in counts if secret)
    missed = int((sum(n for _, n in found) - 1) * (1 - recall))
    return next(z for (z, _), below in zip(found, np.cumsum([n for _, n in found])) if below > missed)


def calibrate(net: Network, counts: list[tuple[bool, int, int]], fixed: list[tuple[bool, int, int]], recall: float = RECALL) -> Network:
    """``net`` with scale and threshold from the (secret, output, number) of all held-out windows and of the fixed ones among them."""
    y, grains, n = (np.array(v) for v in zip(*sorted(counts)))
    z, n = grains / GRAIN, n.astype(float)
    good, total = n[y].sum(), n.sum()
    middle = float((n * z).sum() / total)
    spread = float(np.sqrt((n * (z - middle) ** 2).sum() / total)) + 1e-6
    z = (z - middle) / spread
    a, b, hold = 1.0, 0.0, 0.01 * total  # held near where it begins: labels that can be parted would drive it off
    for _ in range(100):  # Platt scaling, with smoothed labels
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -40, 40)))
        g = n * (p - np.where(y, 1 - 1 / (good + 2), 1 / (total - good + 2)))
        w = n * p * (1 - p)
        h = np.array([[(w * z * z).sum() + hold, (w * z).sum()], [(w * z).sum(), w.sum() + hold]])
        step = np.linalg.solve(h, [(g * z).sum() + hold * (a - 1), g.sum() + hold * b])
        a, b = a - 0.5 * step[0], b - 0.5 * step[1]
    net.scale = (float(a / spread), float(b - a * middle / spread))
    lowest = min(_lowest(counts, recall), _lowest(fixed, recall))
    net.threshold = float(net.calibrated(np.array([lowest - 0.5]))[0])  # between two outputs, so rounding decides nothing
    return net


def fit(secrets: list[str], others: list[str], recall: float = RECALL, steps: int = STEPS, seed: int = 3) -> Network:
    """Train on windows of both labels and the fixed ``examples``; a fifth of each is held out for calibration and threshold."""
    rng = np.random.default_rng(seed)
    net = start(rng)
    fixed = examples()
    good, bad = codes([*secrets, *fixed[0]]), codes([*others, *fixed[1]])
    held_good, held_bad = np.arange(len(good)) % 5 == 0, np.arange(len(bad)) % 5 == 0
    train_good, train_bad = good[~held_good], bad[~held_bad]
    run = _Steps(net, RATES[0])
    for _ in range(steps):
        run.take(_bare(train_good[rng.integers(0, len(train_good), HALF)], bad, rng), train_bad[rng.integers(0, len(train_bad), HALF)])
    found = net.grains(_bare(good[held_good], bad, rng))
    of_fixed = np.flatnonzero(held_good) >= len(secrets)
    net.held = tuple(int(h[:len(w)].sum()) for h, w in ((held_good, secrets), (held_bad, others)))
    net.trained = (len(secrets) - net.held[0], len(others) - net.held[1])
    return calibrate(net, _counted(found, net.grains(bad[held_bad])), _counted(found[of_fixed], found[:0]), recall)


def learn(windows: DataFrame, recall: float = RECALL, seed: int = 3) -> Network:
    """A network from all distinct windows of a table (``secret`` boolean, ``w`` string).

    Up to ``SHARD`` of each label they go through ``fit``. More are dealt to shards, each with the fixed examples
    besides. The result depends on the windows, not on their order or partitions.
    """
    rows = saved(windows.select("secret", "w").distinct(), "secret-windows")
    many = max([0, *(r["n"] for r in rows.groupBy("secret").agg(F.count(F.lit(1)).alias("n")).collect())])
    if many <= SHARD:
        every = rows.orderBy(F.xxhash64("w"), "w").collect()
        return fit([r["w"] for r in every if r["secret"]], [r["w"] for r in every if not r["secret"]], recall, seed=seed)
    dealt = rows.select("secret", "w", (F.pmod(F.xxhash64("w"), F.lit(5)) == 0).alias("held"),
                        F.pmod(F.xxhash64("w", F.lit(seed)), F.lit(-(-many // SHARD))).alias("shard")).groupBy("shard")

    def shown(group: pa.Table) -> Shown:
        secret, held = (group.column(c).to_numpy() for c in ("secret", "held"))
        words = np.array(group.column("w").to_pylist(), object)
        return Shown(*(codes(sorted(words[(secret == s) & (held == h)])) for h in (False, True) for s in (True, False)))

    fixed = Shown.of(*examples())
    net = train(start(np.random.default_rng(seed)), Shown.of([], []), fixed, STEPS // len(RATES), RATES[0], seed)
    for turn, rate in enumerate(RATES):
        def each(key: tuple, group: pa.Table) -> pa.Table:
            own = shown(group)
            made = train(net, own, fixed, STEPS // len(RATES), rate, seed + 1 + turn + len(RATES) * key[0].as_py())
            sizes = [len(own.good), len(own.bad), len(own.held_good), len(own.held_bad)]
            return pa.table({"flat": pa.array([[*made.flat().tolist(), *sizes]], pa.list_(pa.int64()))})

        flat = dealt.applyInArrow(each, "flat array<long>").select(F.posexplode("flat").alias("place", "value"))
        mean = flat.groupBy("place").agg(F.sum("value").alias("sum"), F.count(F.lit(1)).alias("n")).orderBy("place").collect()
        net = net.with_flat(np.array([r["sum"] / r["n"] for r in mean[:-4]]))
        sizes = [r["sum"] for r in mean[-4:]]
        net.trained, net.held = tuple(sizes[:2]), tuple(sizes[2:])

    def outputs(key: tuple, group: pa.Table) -> pa.Table:
        own = shown(group)
        counts = own.counts(net, np.concatenate([fixed.bad, own.bad]), seed + key[0].as_py())
        return pa.Table.from_pylist([dict(zip(("secret", "output", "n"), c)) for c in counts],
                                    pa.schema([("secret", pa.bool_()), ("output", pa.int64()), ("n", pa.int64())]))

    held = dealt.applyInArrow(outputs, "secret boolean, output long, n long").groupBy("secret", "output").agg(F.sum("n").alias("n"))
    counted = {(r["secret"], r["output"]): r["n"] for r in held.collect()}  # at most two for each possible output
    always = fixed.counts(net, fixed.bad, seed)
    for secret, output, n in always:
        counted[secret, output] = counted.get((secret, output), 0) + n
    return calibrate(net, [(*k, n) for k, n in counted.items()], always, recall)


def _seen(docs: DataFrame, text: str, out: str) -> DataFrame:
    """``docs`` with base findings, and windows of findings and candidates."""
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("shown", pa.bool_()),
                      ("windows", pa.list_(pa.string()))])

    def run(texts: pa.StringArray) -> pa.Array:
        rows = []
        all_texts = texts.to_pylist()
        for t, (found, other) in zip(all_texts, scan(all_texts)):
            made = []
            for kind, s, e in found:
                inner = s + ASSIGN.match(t, s).start(2) - s if kind == "assign" else s
                made.append({"kind": kind, "start": s, "end": e, "shown": True, "windows": windows(t, inner, e)})
            made += [{"kind": None, "start": s, "end": e, "shown": not random_like(t[s:e]), "windows": windows(t, s, e)} for s, e in other]
            rows.append(made)
        return pa.array(rows, pa.list_(span))

    kind = "array<struct<kind:string,start:int,end:int,shown:boolean,windows:array<string>>>"
    return with_column(docs, text, out, _type(kind), run)


def _type(ddl: str):
    from pyspark.sql.types import StructType
    return StructType.fromDDL(f"x {ddl}")["x"].dataType


def find(docs: DataFrame, text: str = "text", out: str = "findings", keep: list[str] | None = None,
         recall: float = RECALL) -> DataFrame:
    """Columns ``keep`` (all but ``text`` unless named) of ``docs`` with the secrets of each whole text in ``out``.

    A finding is (kind, start, end, score), places in code points, by start and
    then in the order of ``KINDS``; patterns have score 1. Null and empty texts
    have no findings; every row stays, repeated rows too. Surroundings are
    looked at, so equal tokens may be judged differently.
    """
    keep = [c for c in docs.columns if c != text] if keep is None else keep
    held = "seen"
    while held in docs.columns or held == out:
        held += "_"
    seen = saved(_seen(docs, text, held).select(*keep, held), "secret-candidates")
    window = (seen.select(F.explode(held).alias("s")).where("s.shown")
              .select((F.col("s.kind").isNotNull()).alias("secret"), F.explode("s.windows").alias("w")))
    net = learn(window, recall)
    sent = docs.sparkSession.sparkContext.broadcast(pickle.dumps(net))

    def run(rows: pa.ListArray) -> pa.Array:
        network = pickle.loads(sent.value)
        all_rows = rows.to_pylist()
        asked = [s for r in all_rows for s in r if s["kind"] is None]
        scores = network.score(codes([w for s in asked for w in s["windows"]]))
        at = 0
        for s in asked:
            s["score"] = float(scores[at:at + len(s["windows"])].max())
            at += len(s["windows"])
        made = [[{"kind": s["kind"] or "network", "start": s["start"], "end": s["end"], "score": s.get("score", 1.0)}
                 for s in r if s["kind"] or s["score"] >= network.threshold] for r in all_rows]
        for r in made:
            r.sort(key=lambda f: (f["start"], KINDS.index(f["kind"])))
        return pa.array(made, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                                                  ("score", pa.float64())])))

    return with_column(seen, held, out, _type(FINDING), run).drop(held)
