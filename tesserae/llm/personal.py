"""Personal data: patterns, and a character-level bidirectional LSTM with CRF transitions.

The patterns find email, ip, card and phone. The model, trained here in numpy on labelled spans of made-up texts, tags
characters as one of these or as a secret (keys, tokens, passwords). A text is laid out in windows of WIDTH characters
that overlap by half; those with a digit or an @ are decoded by Viterbi, the others hold nothing that the model knows.
Decisions of overlapping windows are reconciled for the whole text: each character takes the tag of the window in which
it stands nearest to the middle; runs of one tag are spans. A span of the model counts if it is LEAST characters long or
more after trimming, has a digit or an @, and overlaps no span of the patterns. Those tagged as card must pass Luhn.

Every pattern runs in linear time on any text, and very long texts are decoded in parts of some hundred windows. Null counts as empty: no spans. Rows are independent, so repeated rows
and ties need no rule. An empty table gives no rows. Positions are code points, ends exclusive. Columns besides doc_id
and text are not looked at, whatever their names.
"""

from __future__ import annotations

import functools
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import documents, slices

KINDS = ("email", "ip", "card", "phone")
TAGS = ("", *KINDS, "secret")
WIDTH, HIDDEN, LEAST, SEED = 96, 24, 8, 5

DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
ANY = re.compile(r"[0-9@]")


def luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[-1::-2]) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return bool(digits) and total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The patterns' spans, by kind and start."""
    out = []
    last = 0
    for m in DOMAIN.finditer(text):
        start = m.start()
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        if start < m.start():
            out.append(("email", start, m.end()))
            last = m.end()
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(len(q := p.lstrip("0")) <= 3 and int(q or "0") <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in PHONE.finditer(text):
        if 8 <= sum(c in "0123456789" for c in m[0]) <= 15:
            out.append(("phone", *m.span()))
    return out


def classes_of(text: str) -> np.ndarray:
    """Each character's class: ASCII characters are their own, letters and all else beyond have one each."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    return np.where(points < 128, points, np.where(points < 0x3000, 128, 129))


CLASSES = 131  # the last fills windows up


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


class Tagger:
    """Two LSTMs over characters, a linear layer, and a CRF. Inputs enter the gates through a table by class."""

    def __init__(self, seed: int = SEED):
        rnd = np.random.default_rng(seed)
        h, k = HIDDEN, len(TAGS)
        self.p = {"trans": np.zeros((k, k)), "out": rnd.normal(0, 0.2, (2 * h, k)), "bias": np.zeros(k)}
        for d in "fb":
            self.p["in" + d] = rnd.normal(0, 0.3, (CLASSES, 4 * h))
            self.p["in" + d][:, h : 2 * h] += 1  # gates start open
            self.p["rec" + d] = rnd.normal(0, 0.25, (h, 4 * h))

    def _lstm(self, x: np.ndarray, d: str, keep: bool):
        table, rec, h = self.p["in" + d], self.p["rec" + d], HIDDEN
        n, length = x.shape
        state, cell = np.zeros((n, h)), np.zeros((n, h))
        out, kept = np.empty((n, length, h)), []
        for t in range(length) if d == "f" else range(length - 1, -1, -1):
            z = table[x[:, t]] + state @ rec
            gates = sigmoid(z[:, : 3 * h])
            i, f, o, g = gates[:, :h], gates[:, h : 2 * h], gates[:, 2 * h :], np.tanh(z[:, 3 * h :])
            before, was = cell, state
            cell = f * cell + i * g
            squashed = np.tanh(cell)
            state = o * squashed
            out[:, t] = state
            if keep:
                kept.append((t, i, f, o, g, before, squashed, was))
        return out, kept

    def emissions(self, x: np.ndarray, keep: bool = False):
        f, kf = self._lstm(x, "f", keep)
        b, kb = self._lstm(x, "b", keep)
        both = np.concatenate([f, b], axis=2)
        return both @ self.p["out"] + self.p["bias"], both, kf, kb

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log likelihood of the tags y and its gradients."""
        e, both, kf, kb = self.emissions(x, True)
        n, length, k = e.shape
        trans = self.p["trans"]
        fore, back = np.empty_like(e), np.zeros_like(e)
        fore[:, 0] = e[:, 0]
        for t in range(1, length):
            fore[:, t] = e[:, t] + log_sum(fore[:, t - 1, :, None] + trans, 1)
        for t in range(length - 2, -1, -1):
            back[:, t] = log_sum(trans + (e[:, t + 1] + back[:, t + 1])[:, None, :], 2)
        z = log_sum(fore[:, -1], 1)
        rows = np.arange(n)[:, None]
        gold = e[rows, np.arange(length), y].sum() + trans[y[:, :-1], y[:, 1:]].sum()
        de = np.exp(fore + back - z[:, None, None])
        pair = np.exp(fore[:, :-1, :, None] + trans + (e + back)[:, 1:, None, :] - z[:, None, None, None]).sum(axis=(0, 1))
        np.add.at(pair, (y[:, :-1].ravel(), y[:, 1:].ravel()), -1)
        de[rows, np.arange(length), y] -= 1
        de /= n
        g = {"trans": pair / n, "out": np.einsum("nth,ntk->hk", both, de), "bias": de.sum(axis=(0, 1))}
        dboth = de @ self.p["out"].T
        for d, kept, part in (("f", kf, dboth[:, :, :HIDDEN]), ("b", kb, dboth[:, :, HIDDEN:])):
            dtable, drec = np.zeros_like(self.p["in" + d]), np.zeros_like(self.p["rec" + d])
            dstate, dcell = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN))
            for t, i, f, o, c, before, squashed, was in reversed(kept):
                dh = part[:, t] + dstate
                dcell = dcell + dh * o * (1 - squashed**2)
                dz = np.concatenate([dcell * c * i * (1 - i), dcell * before * f * (1 - f), dh * squashed * o * (1 - o), dcell * i * (1 - c**2)], axis=1)
                np.add.at(dtable, x[:, t], dz)
                drec += was.T @ dz
                dstate, dcell = dz @ self.p["rec" + d].T, dcell * f
            g["in" + d], g["rec" + d] = dtable, drec
        return float(z.sum() - gold) / n, g

    def viterbi(self, x: np.ndarray) -> np.ndarray:
        e = self.emissions(x)[0]
        n, length, k = e.shape
        score, steps = e[:, 0], np.empty((n, length, k), np.int8)
        for t in range(1, length):
            through = score[:, :, None] + self.p["trans"]
            steps[:, t] = through.argmax(axis=1)
            score = through.max(axis=1) + e[:, t]
        out = np.empty((n, length), np.int8)
        out[:, -1] = score.argmax(axis=1)
        for t in range(length - 1, 0, -1):
            out[:, t - 1] = steps[np.arange(n), t, out[:, t]]
        return out


def made_up(rnd: random.Random, length: int = WIDTH) -> tuple[str, list[int]]:
    """A made-up text and its characters' tags."""
    letters = "abcdefghijklmnoprstuvwz"
    word = lambda a=2, b=9: "".join(rnd.choice(letters + ("äéñöüß" if rnd.random() < 0.1 else "")) for _ in range(rnd.randint(a, b)))
    digits = lambda n: "".join(rnd.choice("0123456789") for _ in range(n))
    pick = lambda chars, n: "".join(rnd.choice(chars) for _ in range(n))

    def secret() -> str:
        return rnd.choice(
            [
                lambda: "AKIA" + pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 16),
                lambda: pick("0123456789abcdef", rnd.choice([16, 18, 20, 32, 40])),
                lambda: rnd.choice(["sk-", "ghp_", "xoxb-"]) + pick("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", rnd.randint(20, 36)),
            ]
        )()

    def card() -> str:
        s = rnd.choice("3456") + digits(15)
        return rnd.choice([s, " ".join(s[i : i + 4] for i in range(0, 16, 4)), "-".join(s[i : i + 4] for i in range(0, 16, 4))])

    def phone() -> str:
        a, b, c = digits(3), digits(3), digits(4)
        return rnd.choice([f"+{rnd.randint(1, 99)} ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"+{rnd.randint(1, 99)} {a} {b} {c}", f"{a}.{b}.{c}", f"00{rnd.randint(30, 49)} {a} {b}{c}"])

    spans = {
        1: lambda: f"{word()}{rnd.choice(['.', '_', ''])}{rnd.choice([word(), digits(2)])}@{word()}{rnd.choice(['', digits(1)])}.{rnd.choice(['com', 'org', 'example.com', 'de', 'co.uk'])}",
        2: lambda: ".".join(str(rnd.randint(0, 255)) for _ in range(4)),
        3: card,
        4: phone,
        5: secret,
    }
    plain = [
        lambda: f"version {rnd.randint(1, 9)}.", lambda: f"{rnd.randint(1, 20)}.{rnd.randint(0, 9)}.", lambda: f"{rnd.randint(1900, 2030)}", lambda: f"{rnd.randint(2000, 2030)}-{digits(2)}-{digits(2)}",
        lambda: f"{digits(rnd.randint(1, 7))}", lambda: f"{digits(2)}:{digits(2)}", lambda: f"${digits(2)},{digits(3)}.{digits(2)}", lambda: f"@{word()}", lambda: f"{word()}{digits(2)}", lambda: f"{digits(2)}%",
    ]
    text, tags = "", []

    def add(s: str, tag: int = 0) -> None:
        nonlocal text
        text += s
        tags.extend([tag] * len(s))

    add("".join(word() + " " for _ in range(rnd.randint(0, 6))))
    while len(text) < length:
        r = rnd.random()
        if r < 0.25:
            tag = rnd.randint(1, 5)
            if tag == 5 and rnd.random() < 0.6:
                name = rnd.choice(["token", "password", "api_key", "secret", "key"])
                add(name + rnd.choice(["=", " = ", ": "]))
                quote = rnd.choice(["", '"'])
                add(quote), add(spans[5](), 5), add(quote)
            else:
                add(spans[tag](), tag)
            add(rnd.choice([" ", " ", ".", ", ", "\n"]))
        elif r < 0.4:
            add(rnd.choice(plain)() + " ")
        else:
            w = word()
            add((w.title() if rnd.random() < 0.15 else w.upper() if rnd.random() < 0.05 else w) + rnd.choice([" ", " ", " ", ", ", ".\n", "!! ", " | "]))
    cut = rnd.randint(0, len(text) - length)
    return text[cut : cut + length], tags[cut : cut + length]


def training_set(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rnd = random.Random(seed)
    rows = [made_up(rnd) for _ in range(n)]
    return np.array([classes_of(t) for t, _ in rows]), np.array([g for _, g in rows])


@functools.lru_cache(maxsize=4)
def trained(rows: int = 2400, epochs: int = 10, batch: int = 48, rate: float = 0.03, seed: int = SEED) -> Tagger:
    """The same parameters give the same model."""
    x, y = training_set(rows, seed)
    tagger, rnd = Tagger(seed), np.random.default_rng(seed)
    first = {k: np.zeros_like(v) for k, v in tagger.p.items()}
    second = {k: np.zeros_like(v) for k, v in tagger.p.items()}
    step, steps = 0, epochs * (rows // batch)
    for _ in range(epochs):
        order = rnd.permutation(rows)
        for at in range(0, rows - batch + 1, batch):
            step += 1
            _, g = tagger.gradients(x[order[at : at + batch]], y[order[at : at + batch]])
            size = np.sqrt(sum((v**2).sum() for v in g.values()))
            now = rate * (1 - step / (steps + 1)) * min(1.0, 5.0 / size)
            for k, v in g.items():
                first[k] = 0.9 * first[k] + 0.1 * v
                second[k] = 0.99 * second[k] + 0.01 * v * v
                tagger.p[k] -= now * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
    return tagger


def model_spans(tagger: Tagger, texts: list[str], most: int = 512) -> list[list[tuple[str, int, int]]]:
    """The model's spans of each text."""
    half = WIDTH // 2
    work: list[tuple[int, int]] = []  # text, start of the window
    for i, t in enumerate(texts):
        near: set[int] = set()
        for m in ANY.finditer(t):
            k = m.start() // half
            near.update((k * half, (k - 1) * half))
        work += [(i, s) for s in sorted(near)]
    tags = {i: np.zeros(len(texts[i]), np.int8) for i, _ in work}
    quarter = half // 2
    for at in range(0, len(work), most):
        part = work[at : at + most]
        x = np.full((len(part), WIDTH), CLASSES - 1)
        for row, (i, s) in zip(x, part):
            piece = classes_of(texts[i][max(s, 0) : s + WIDTH])
            row[max(-s, 0) : max(-s, 0) + len(piece)] = piece
        for row, (i, s) in zip(tagger.viterbi(x), part):
            # the middle half of a window is nearer to its middle than to any other's
            low, high = max(s + quarter, 0), min(s + WIDTH - quarter, len(texts[i]))
            if low < high:
                tags[i][low:high] = row[low - s : high - s]
    out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    for i, tag in tags.items():
        cuts = np.flatnonzero(np.diff(np.concatenate([[0], tag, [0]])))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if kind := TAGS[tag[a]]:
                piece = texts[i][a:b]
                a, b = a + len(piece) - len(piece.lstrip(" \n\t\"',.:;")), b - len(piece) + len(piece.rstrip(" \n\t\"',.:;"))
                real = kind != "card" or luhn("".join(c for c in texts[i][a:b] if c in "0123456789"))
                if b - a >= LEAST and ANY.search(texts[i], a, b) and real:
                    out[i].append((kind, a, b))
    return out


def found(tagger: Tagger, texts: list[str]) -> Iterator[tuple[list, list]]:
    """Base spans and all spans of each text, by kind and start."""
    order = {k: i for i, k in enumerate(TAGS[1:])}
    with_any = [i for i, t in enumerate(texts) if ANY.search(t)]
    more = dict(zip(with_any, model_spans(tagger, [texts[i] for i in with_any])))
    for i, t in enumerate(texts):
        base = base_spans(t) if i in more else []
        taken = np.zeros(len(t) if base else 0, bool)
        for _, a, b in base:
            taken[a:b] = True
        own = [s for s in more.get(i, ()) if not taken[s[1] : s[2]].any()]
        yield base, sorted(base + own, key=lambda s: (order[s[0]], s[1], s[2]))


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def scanned(docs: DataFrame, tagger: Tagger | None = None) -> DataFrame:
    """doc_id, base and spans: arrays of kind, start and end."""
    tagger = tagger or trained()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        show = lambda spans: [{"kind": k, "start": a, "end": b} for k, a, b in spans]
        for b in slices(batches, "text"):
            both = list(found(tagger, [t or "" for t in b.column("text").to_pylist()]))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([show(x) for x, _ in both], kind), pa.array([show(y) for _, y in both], kind)], ["doc_id", "base", "spans"])

    span = "array<struct<kind: string, start: int, end: int>>"
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", docs["text"].cast("string").alias("text")).mapInArrow(work, f"doc_id {kind}, base {span}, spans {span}")


def op9_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s.getField("kind"), s.getField("start"), s.getField("end"))), ",")
    count = lambda k: F.size(F.filter("base", lambda s: s.getField("kind") == k)).cast("long").alias(f"n_{k}")
    secrets = F.size(F.filter("spans", lambda s: s.getField("kind") == "secret")).cast("long").alias("n_secret")
    return scanned(documents(spark, sf_dir)).select("doc_id", *map(count, KINDS), F.sha2(text("base"), 256).alias("base_sha256"), text("spans").alias("spans"), secrets)
