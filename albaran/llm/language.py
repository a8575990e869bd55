"""The language of documents and of the paragraphs of mixed ones, by a byte convolutional network.

The network: bytes of a fixed-length window, embedded, filters of several widths, maximum over the window, softmax.
It is trained in numpy on a bounded sample of labelled rows (``SAMPLE`` documents with the least hashes of their ids);
as some labels are wrong, windows that a first round contradicts are left out of the second. All texts are then read
whole: every line that holds a sentence goes through the network in windows, and a paragraph gets the mean of its
windows' probabilities.

Defined results: NULL, empty and blank texts and texts without a sentence give no row; blank lines at either end part
nothing; a paragraph without a sentence counts for the numbers but gives no row; rows repeat where ids repeat.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from albaran.functions.lookup import lookup
from albaran.session import ship

LANGS = ("en", "es", "pt", "fr", "de", "it", "nl")
SAMPLE = 6000
WINDOW, STRIDE = 112, 108
# Names and codes of the languages as people write them.
LABELS = """
en: eng english ingles inglés anglais englisch inglese engels
es: spa esp spanish espanol español castellano castilian espagnol spanisch spagnolo spaans
pt: por portuguese portugues português portugués portugais portugiesisch portoghese portugees
fr: fra fre french francais français frances francés französisch franzosisch francese frans
de: deu ger german deutsch aleman alemán alemão allemand tedesco duits
it: ita italian italiano italien italienisch italiaans
nl: nld dut dutch nederlands holandes holandés neerlandes neerlandés néerlandais niederländisch olandese flemish vlaams
"""
LABEL_OF = {w: line[:2] for line in LABELS.strip().split("\n") for w in [line[:2], *line[3:].split()]}
# Labels that name no language.
NO_LABEL = frozenset(("", "und", "mul", "xx", "zxx", "mis", "unknown", "?", "n/a", "na", "none", "null", "-"))

BLANK = re.compile(r"(?:\r?\n|\r)[^\S\r\n]*(?:\r?\n|\r)\s*")
WORD = re.compile(r"[^\W\d_]{2,}")
LINE = re.compile(r"\r\n|\n|\r")
LABELLED = re.compile(r"\s*[^\s:]+(?: [^\s:]+){0,3}\s?:(?:\s|$)")
CELL = re.compile(r"\s\|\s")


def label_code(label: str | None) -> str | None:
    """Two-letter code of a label in any notation, 'other' for another language, None if it names none."""
    s = (label or "").strip().lower()
    if s in NO_LABEL:
        return None
    if s in LABEL_OF:
        return LABEL_OF[s]
    head = re.split(r"[-_ (]", s)[0]
    return LABEL_OF.get(head, "other")


def paragraphs(text: str) -> list[str]:
    return [p for p in BLANK.split(text.strip()) if p.strip()]


def sentences_of(paragraph: str, words: int = 7) -> str:
    """The lines of a paragraph that hold a sentence: enough words, no table row.

    Lines that were wrapped are counted as one: a line that ends without a mark, and the next one that begins with a
    small letter, unless one of them is a field with its label.
    """
    whole: list[list[str]] = []
    for line in LINE.split(paragraph):
        bare = line.strip()
        if len(CELL.findall(line)) >= 2 or not bare:
            whole.append([])
        elif whole and whole[-1] and bare[0].islower() and whole[-1][-1].rstrip()[-1] not in ".!?:;" and not LABELLED.match(line) and not LABELLED.match(whole[-1][-1]):
            whole[-1].append(line)
        else:
            whole.append([line])
    return "\n".join(line for group in whole if sum(len(WORD.findall(x)) for x in group) >= words for line in group)


def windows(text: str) -> np.ndarray:
    """(n, WINDOW) bytes, zero-padded: every byte of the text is in a window."""
    raw = np.frombuffer(text.encode("utf-8"), np.uint8)
    n = 1 + max(0, -(-(len(raw) - WINDOW) // STRIDE))
    out = np.zeros((n, WINDOW), np.uint8)
    for i in range(n):
        piece = raw[i * STRIDE : i * STRIDE + WINDOW]
        out[i, : len(piece)] = piece
    return out


@dataclass
class ByteCnn:
    """embedding (256, e), filters {width: (width * e, f)}, biases, output layer."""

    emb: np.ndarray
    filters: dict[int, np.ndarray]
    bias: dict[int, np.ndarray]
    out: np.ndarray
    out_bias: np.ndarray

    @classmethod
    def fresh(cls, rng: np.random.Generator, classes: int, e: int = 8, f: int = 32, widths: tuple[int, ...] = (2, 3, 4, 5)) -> ByteCnn:
        g = lambda *s, k: (rng.standard_normal(s) * k).astype(np.float32)
        return cls(
            g(256, e, k=0.5),
            {w: g(w * e, f, k=(2 / (w * e)) ** 0.5) for w in widths},
            {w: np.zeros(f, np.float32) for w in widths},
            g(f * len(widths), classes, k=0.1),
            np.zeros(classes, np.float32),
        )

    def _patches(self, x: np.ndarray, w: int) -> np.ndarray:
        v = np.lib.stride_tricks.sliding_window_view(x, w, axis=1)  # (b, L-w+1, e, w)
        return np.ascontiguousarray(v.transpose(0, 1, 3, 2)).reshape(x.shape[0], x.shape[1] - w + 1, -1)

    def _stacked(self) -> np.ndarray:
        """All filters as one matrix, the narrow ones padded with zeros."""
        most = max(self.filters) * self.emb.shape[1]
        return np.concatenate([np.pad(k, ((0, most - len(k)), (0, 0))) for k in self.filters.values()], axis=1)

    def hidden(self, b: np.ndarray, stacked: np.ndarray) -> np.ndarray:
        """One product for the filters of all widths, then the maximum over the places where each fits."""
        n, size = b.shape
        e, most = self.emb.shape[1], max(self.filters)
        x = np.zeros((n, size + most - 1, e), np.float32)
        x[:, :size] = self.emb[b]
        h = (np.lib.stride_tricks.as_strided(x, (n, size, most * e), x.strides).reshape(n * size, -1) @ stacked).reshape(n, size, -1)
        c = 0
        for w, k in self.filters.items():
            h[:, size - w + 1 :, c : c + k.shape[1]] = -np.inf  # where the filter would reach beyond the window
            c += k.shape[1]
        return np.maximum(h.max(axis=1) + np.concatenate(list(self.bias.values())), 0)

    def proba(self, b: np.ndarray, step: int = 64) -> np.ndarray:
        """step: windows at a time, so few that they stay in the cache."""
        parts, stacked = [], self._stacked()
        for i in range(0, len(b), step):
            z = self.hidden(b[i : i + step], stacked) @ self.out + self.out_bias
            z = np.exp(z - z.max(axis=1, keepdims=True))
            parts.append(z / z.sum(axis=1, keepdims=True))
        return np.concatenate(parts) if parts else np.zeros((0, len(self.out_bias)), np.float32)

    def fit(self, b: np.ndarray, y: np.ndarray, rng: np.random.Generator, epochs: int, rate: float = 3e-3, step: int = 64) -> None:
        """Adam on the cross entropy."""
        params = [self.emb, self.out, self.out_bias, *self.filters.values(), *self.bias.values()]
        m = [np.zeros_like(p) for p in params]
        v = [np.zeros_like(p) for p in params]
        t = 0
        for _ in range(epochs):
            order = rng.permutation(len(b))
            for i in range(0, len(b), step):
                at = order[i : i + step]
                xb, yb = b[at], y[at]
                x = self.emb[xb]
                pooled, keep = [], []
                for w, k in self.filters.items():
                    p = self._patches(x, w)
                    h = p @ k + self.bias[w]
                    best = h.argmax(axis=1)
                    pooled.append(np.take_along_axis(h, best[:, None, :], 1)[:, 0])
                    keep.append((w, p, best))
                a = np.concatenate(pooled, axis=1)
                r = np.maximum(a, 0)
                z = r @ self.out + self.out_bias
                z = np.exp(z - z.max(axis=1, keepdims=True))
                z /= z.sum(axis=1, keepdims=True)
                z[np.arange(len(at)), yb] -= 1
                z /= len(at)
                g_out, g_ob = r.T @ z, z.sum(axis=0)
                da = (z @ self.out.T) * (a > 0)
                g_emb = np.zeros_like(self.emb)
                g_f, g_b, c = [], [], 0
                for w, p, best in keep:
                    f = self.filters[w].shape[1]
                    d = da[:, c : c + f]
                    c += f
                    rows = np.take_along_axis(p, best[:, :, None], 1)  # (b, f, w*e)
                    g_f.append(np.einsum("bf,bfk->kf", d, rows, optimize=True))
                    g_b.append(d.sum(axis=0))
                    back = d[:, :, None] * self.filters[w].T[None]  # (b, f, w*e)
                    e = self.emb.shape[1]
                    ids = xb[np.arange(len(at))[:, None, None], best[:, :, None] + np.arange(w)]  # (b, f, w)
                    flat, val = ids.ravel(), back.reshape(-1, e)
                    for j in range(e):
                        g_emb[:, j] += np.bincount(flat, val[:, j], 256).astype(np.float32)
                t += 1
                for n, (p, g) in enumerate(zip(params, [g_emb, g_out, g_ob, *g_f, *g_b])):
                    m[n] += 0.1 * (g - m[n])
                    v[n] += 0.001 * (g * g - v[n])
                    p -= (rate * (m[n] / (1 - 0.9**t)) / (np.sqrt(v[n] / (1 - 0.999**t)) + 1e-8)).astype(np.float32)


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang", sample: int = SAMPLE, most_windows: int = 12000, seed: int = 7) -> ByteCnn:
    """The network from at most `sample` labelled rows: those with the least hashes of the id, a bounded top-k.

    Only texts of at most 5,000 characters are taken for the sample, so that it stays under 30 MB.
    """
    known = F.lower(F.trim(F.col(label)))
    forms = sorted(LABEL_OF)
    mine = F.split(known, "[-_ (]").getItem(0).isin(forms)
    rows = docs.where(mine & (F.length(text) > 40) & (F.length(text) <= 5_000)).select(key, text, label)
    picked = rows.orderBy(F.xxhash64(F.col(key)), F.col(key), F.col(text)).limit(sample).collect()
    rng = np.random.default_rng(seed)
    xs, ys = [], []
    for r in picked:
        code = label_code(r[label])
        prose = sentences_of(r[text])
        if code in LANGS and prose:
            w = windows(prose)
            w = w[rng.permutation(len(w))[:6]]
            xs.append(w)
            ys += [LANGS.index(code)] * len(w)
            one = windows(prose.split("\n")[0][: int(rng.integers(50, 110))])[:1]  # short ones too
            xs.append(one)
            ys.append(LANGS.index(code))
    net = ByteCnn.fresh(rng, len(LANGS))
    if not xs:
        return net
    x, y = np.concatenate(xs), np.array(ys)
    order = rng.permutation(len(x))
    # even out the languages as far as the sample allows
    share = np.zeros(len(LANGS), int)
    most = max(1, most_windows // len(LANGS)) * 2
    pick = []
    for i in order:
        if share[y[i]] < most and len(pick) < most_windows:
            share[y[i]] += 1
            pick.append(i)
    x, y = x[pick], y[pick]
    net.fit(x, y, rng, epochs=1)
    p = net.proba(x)
    right = ~((p.argmax(axis=1) != y) & (p.max(axis=1) > 0.7))
    net.fit(x[right], y[right], rng, epochs=3, rate=2e-3)
    p = net.proba(x)
    right = ~((p.argmax(axis=1) != y) & (p.max(axis=1) > 0.7))
    net.fit(x[right], y[right], rng, epochs=1, rate=7e-4)
    return net


SEGMENTS = "`{key}` {kind}, seg_no int, lang string, confidence double, mixed boolean, label string"


def segments(docs: DataFrame, net: ByteCnn, key: str = "doc_id", text: str = "text", label: str = "lang", sure: float = 0.55) -> DataFrame:
    """One row (seg_no 0) for each text in one language, one row for each paragraph with a sentence of a mixed one.

    A paragraph that the network is less sure of than `sure` doesn't make a text a mixed one. One pass, no shuffle;
    the network (some 100 KB, whatever the corpus) goes out with the task.
    """
    ship(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for at in range(0, len(whole), 256):
                b = whole.iloc[at : at + 256]
                todo: list[tuple[int, int, int]] = []  # row, paragraph number, windows
                parts: list[np.ndarray] = []
                for i, t in enumerate(b[text]):
                    if not isinstance(t, str):
                        continue
                    for n, p in enumerate(paragraphs(t), 1):
                        if prose := sentences_of(p):
                            w = windows(prose)
                            todo.append((i, n, len(w)))
                            parts.append(w)
                if not todo:
                    continue
                proba = net.proba(np.concatenate(parts))
                ends = np.cumsum([n for _, _, n in todo])
                by: dict[int, list[tuple[int, np.ndarray, int]]] = {}
                for (i, n, k), end in zip(todo, ends):
                    by.setdefault(i, []).append((n, proba[end - k : end].mean(axis=0), k))
                out = []
                for i, found in by.items():
                    mean = sum(p * k for _, p, k in found) / sum(k for _, _, k in found)
                    firm = {int(p.argmax()) for _, p, _ in found if p.max() >= sure} or {int(mean.argmax())}
                    doc, said = b[key].iloc[i], b[label].iloc[i]
                    said = said if isinstance(said, str) else None
                    if len(firm) == 1:
                        best = next(iter(firm))
                        out.append((doc, 0, LANGS[best], float(mean[best]), False, said))
                    else:
                        out += [(doc, n, LANGS[int(p.argmax())], float(p.max()), True, said) for n, p, _ in found]
                yield pd.DataFrame(out, columns=[key, "seg_no", "lang", "confidence", "mixed", "label"])

    return docs.select(key, text, label).mapInPandas(run, SEGMENTS.format(key=key, kind=kind))


def corrections(found: DataFrame) -> DataFrame:
    """The rows of segments whose label is missing, meaningless or of another language, and all of mixed texts."""
    s = F.lower(F.trim(F.coalesce(F.col("label"), F.lit(""))))
    code = F.coalesce(lookup(LABEL_OF, s), lookup(LABEL_OF, F.split(s, "[-_ (]").getItem(0)))
    return found.where(F.col("mixed") | code.isNull() | (code != F.col("lang")))
