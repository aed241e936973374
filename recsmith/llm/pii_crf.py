"""Personal data: fixed patterns plus a semi-Markov conditional random field.

Base spans come from four patterns with their checks (email, ip, card, phone),
each scanned leftmost and non-overlapping in time linear in the text. Around
digits and at-signs short regions are cut; over a region's tokens a segmental
model scores whole candidate spans (at most ``MAX_TOKENS`` tokens) by type from
features of the span as a unit, single tokens as outside, and transitions
between types. Dynamic programming chooses boundaries and types jointly; a
chosen span that meets no base span and whose posterior reaches ``min_prob`` is
added. Base spans always stay.

Training: maximum likelihood by forward-backward on a bounded sample of regions
(``sample``, the smallest by hash of their text over all documents), labelled by
the base spans; some are re-rendered (phone without plus, masked at-sign,
dotted card) under the same label, so the model learns forms the patterns miss.

Defined cases: null or empty text has no spans; a corpus without base spans
adds none; every row is treated on its own, repeated or null ids included;
other columns stay as they are.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from recsmith.llm.common import map_batches, store

KINDS = ("email", "ip", "card", "phone")
SAMPLE = 800
MAX_TOKENS = 16
CONTEXT = 48

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]++(?:\.[0-9]++){3}")
DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile("[^0-9]+")

TOKEN = re.compile(r"[0-9]+|[A-Za-z]+|[\(\[]at[\)\]]|.", re.S)
TRIGGER = re.compile(r"[0-9@]+|[\(\[]at[\)\]]")
MARK = re.compile(r"[\(\[]at[\)\]]")
CUES = (("email", ("mail", "email", "contact")), ("ip", ("ip", "host", "server")),
        ("card", ("card", "visa", "credit")), ("phone", ("phone", "tel", "call", "fax", "mobile")))


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def octets(parts: list[str]) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by the patterns, in order of kind and start."""
    out = []
    done, at = 0, text.find("@")
    while at >= 0:
        head = text[done:at]
        start = done + len(head.rstrip(LOCAL))
        m = DOMAIN.match(text, at) if start < at else None
        done = m.end() if m else at + 1
        if m:
            out.append((0, start, done))
        at = text.find("@", done)
    for chain in DOTTED.finditer(text):
        if "." in chain.group():
            out += [(1, chain.start() + m.start(), chain.start() + m.end()) for m in IP.finditer(chain.group())
                    if octets(m.group().split("."))]
    for m in CARD.finditer(text):
        digits = NOT_DIGIT.sub("", m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    for m in PHONE.finditer(text):
        if 8 <= len(NOT_DIGIT.sub("", m.group())) <= 15:
            out.append((3, *m.span()))
    return out


def regions(text: str) -> list[tuple[int, int]]:
    """Stretches that may hold a span the model could choose."""
    out: list[list[int]] = []
    for m in TRIGGER.finditer(text):
        lo, hi = max(0, m.start() - CONTEXT), min(len(text), m.end() + CONTEXT)
        if out and lo <= out[-1][1]:
            out[-1][1] = hi
        else:
            out.append([lo, hi])
    keep = []
    for lo, hi in out:
        part = text[lo:hi]
        if "@" in part or sum(map(part.count, "0123456789")) >= 7 or MARK.search(part):
            keep.append((lo, hi))
    return keep


N_FEATURES = 24
GROUPS = re.compile(r"\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-][0-9]{4}$")
MAILISH = re.compile(r"[A-Za-z0-9._%+-]+ ?(?:@|[\(\[]at[\)\]]) ?[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}$")
DIALLED = re.compile(r"[0-9 +().-]+$")
CARDED = re.compile(r"[0-9]+(?:[ .-][0-9]+)*$")


def features(region: str, start: int, end: int, digits: str) -> list[int]:
    """Indices of the binary features of a whole span."""
    s = region[start:end]
    n = len(digits)
    on = [0, 1 if n < 7 else 2 if n <= 15 else 3 if n <= 19 else 4]
    if 16 <= n <= 19:
        on.append(5 if luhn(digits) else 6)
    if s[0] == "+":
        on.append(7)
    if "@" in s:
        on.append(8)
    if MARK.search(s):
        on.append(9)
    parts = s.split(".")
    if len(parts) == 4 and all(p.isascii() and p.isdigit() for p in parts):
        on.append(10 if octets(parts) else 11)
    if MAILISH.match(s):
        on.append(12)
    if DIALLED.match(s):
        on.append(13)
        if GROUPS.search(s):
            on.append(14)
    if CARDED.match(s):
        on.append(15)
    if any(c.isalpha() for c in s):
        on.append(16)
    before, after = region[max(0, start - 1):start], region[end:end + 1]
    if before and (before.isalnum() or before in "@._+-/="):
        on.append(17)
    if after and (after.isalnum() or after in "@_/=" or after in ".-" and region[end + 1:end + 2].isalnum()):
        on.append(18)
    if s.isdigit():
        on.append(19)
    words = re.findall(r"[a-z]+", region[max(0, start - 20):start].lower())[-2:]
    on += [20 + k for k, (_, cue) in enumerate(CUES) if any(w in cue for w in words)]
    return on


def candidates(region: str) -> tuple[list[int], list[tuple[int, int, list[int]]]]:
    """Token starts (and the end), and (first, past last, features) of the spans
    that can be an entity."""
    cut = [m.start() for m in TOKEN.finditer(region)] + [len(region)]
    toks = [region[a:b] for a, b in zip(cut, cut[1:])]
    kind = ["d" if t[0] in "0123456789" else "a" if t[0].isascii() and t[0].isalpha() else t if len(t) == 1 else "m"
            for t in toks]
    spans = []
    for i, k in enumerate(kind):
        if k not in ("d", "a", "+", "(", ".", "_", "%", "-") or k in ".%-" and "@" not in kind[i:i + MAX_TOKENS]:
            continue
        digits, mail, dots, word = "", False, 0, False
        for j in range(i, min(i + MAX_TOKENS, len(toks))):
            if kind[j] in "\n\r\t":
                break
            if kind[j] == "d":
                digits += toks[j]
            mail |= kind[j] in ("@", "m")
            word |= kind[j] == "a"
            dots += kind[j] == "."
            # Only an address holds letters; other spans need the digits of a number.
            if kind[j] in ("d", "a") and (MAILISH.match(region[cut[i]:cut[j + 1]]) if mail else not word and (
                    len(digits) >= 7 or dots >= 3 and len(digits) >= 4)):
                spans.append((i, j + 1, features(region, cut[i], cut[j + 1], digits)))
    return cut, spans


class Model:
    """Weights of a span by type, of an outside token, and of transitions
    between the types of neighbouring segments (0: outside)."""

    def __init__(self, span: np.ndarray, outside: np.ndarray, step: np.ndarray):
        self.span, self.outside, self.step = span, outside, step

    def scores(self, region: str):
        cut, spans = candidates(region)
        out = [self.outside[outside_kind(region[a:b])] for a, b in zip(cut, cut[1:])]
        ends: list[list] = [[] for _ in cut]
        for i, j, on in spans:
            ends[j].append((i, self.span[:, on].sum(axis=1)))
        return cut, out, ends

    def find(self, region: str, min_prob: float) -> list[tuple[int, int, int]]:
        """(kind, start, end) chosen for a region."""
        cut, out, ends = self.scores(region)
        if not any(ends):
            return []
        n, types = len(out), len(KINDS) + 1
        best, back = np.full((n + 1, types), -np.inf), [[None] * types for _ in range(n + 1)]
        total = np.full((n + 1, types), -np.inf)
        best[0, 0] = total[0, 0] = 0.0
        for j in range(1, n + 1):
            came = best[j - 1] + self.step[:, 0]
            best[j, 0], back[j][0] = came.max() + out[j - 1], (j - 1, int(came.argmax()))
            total[j, 0] = logsum(total[j - 1] + self.step[:, 0]) + out[j - 1]
            for i, score in ends[j]:
                came = best[i][:, None] + self.step[:, 1:]
                top = came.max(axis=0) + score
                summed = np.logaddexp.reduce(total[i][:, None] + self.step[:, 1:], axis=0) + score
                total[j, 1:] = np.logaddexp(total[j, 1:], summed)
                for y in np.flatnonzero(top > best[j, 1:]):
                    best[j, y + 1], back[j][y + 1] = top[y], (i, int(came[:, y].argmax()))
        chosen, j, y = [], n, int(best[n].argmax())
        while j:
            i, before = back[j][y]
            if y:
                chosen.append((i, j, y))
            j, y = i, before
        if not chosen:
            return []
        rest = self.backward(out, ends)
        whole = logsum(total[n])
        found = []
        for i, j, y in chosen:
            score = next(s for a, s in ends[j] if a == i)[y - 1]
            prob = np.exp(logsum(total[i] + self.step[:, y]) + score + rest[j, y] - whole)
            if prob >= min_prob:
                found.append((y - 1, cut[i], cut[j]))
        return found[::-1]

    def backward(self, out, ends) -> np.ndarray:
        """Log sums over what may follow a segment of each type that ends at each place."""
        n = len(out)
        starts: list[list] = [[] for _ in range(n + 1)]
        for j, spans in enumerate(ends):
            for i, score in spans:
                starts[i].append((j, score))
        rest = np.full((n + 1, len(KINDS) + 1), -np.inf)
        rest[n] = 0.0
        for i in range(n - 1, -1, -1):
            acc = self.step[:, 0] + out[i] + rest[i + 1, 0]
            for j, score in starts[i]:
                acc = np.logaddexp(acc, np.logaddexp.reduce(self.step[:, 1:] + (score + rest[j, 1:])[None, :], axis=1))
            rest[i] = acc
        return rest


def logsum(x: np.ndarray) -> float:
    return float(np.logaddexp.reduce(x))


def outside_kind(token: str) -> int:
    """Feature of a token outside any span: plain, short number, long number, at."""
    if token[0] in "0123456789":
        return 1 if len(token) < 7 else 2
    return 3 if token == "@" or len(token) > 1 and token[0] in "([" else 0


OUTSIDE = 4


def rerender(region: str, gold: list[tuple[int, int, int]]) -> tuple[str, list[tuple[int, int, int]]]:
    """The region with some of its spans written in forms the patterns do not
    take, chosen by a hash of the region; the labels move along."""
    pick = hashlib.sha256(region.encode()).digest()
    out, at, labels = "", 0, []
    for n, (kind, start, end) in enumerate(gold):
        out += region[at:start]
        s, how = region[start:end], pick[n % 32] % 3
        if how and kind == 0:
            s = s.replace("@", ("(at)", "[at]")[how - 1])
        elif how == 1 and kind == 2:
            s = ".".join(re.findall("[0-9]{1,4}", NOT_DIGIT.sub("", s)))
        elif how and kind == 3:
            s = re.sub(r"^\+[0-9]{1,3}[ .-]*", "", s) if how == 1 else s
        labels.append((kind, len(out), len(out) + len(s)))
        out, at = out + s, end
    return out + region[at:], labels


def train(sample: list[tuple[str, list[tuple[int, int, int]]]], rounds: int = 80, rate: float = 0.2,
          decay: float = 3e-4, max_tokens: int = 96) -> Model | None:
    """Fit on regions with their labels; None if no label is usable."""
    rows = []
    for region, gold in sample:
        gold = sorted((g for g in gold), key=lambda g: g[1])
        gold = [g for k, g in enumerate(gold) if not k or g[1] >= gold[k - 1][2]]
        plain, (text, labels) = (region, gold), rerender(region, gold)
        for text, labels in [plain] + [(text, labels)] * (text != region):
            cut, spans = candidates(text)
            if len(cut) - 1 > max_tokens or not spans:
                continue
            at = {c: i for i, c in enumerate(cut)}
            index = {(i, j): k for k, (i, j, _) in enumerate(spans)}
            path = [(at[s], at[e], kind) for kind, s, e in labels
                    if s in at and e in at and (at[s], at[e]) in index]
            rows.append((text, cut, spans, path, index))
    if not any(r[3] for r in rows):
        return None
    return _fit(rows, rounds, rate, decay, max_tokens)


def by_row(x: np.ndarray, row: np.ndarray, n_rows: int) -> np.ndarray:
    """Log sums of the lines of ``x`` by their (ascending) row numbers."""
    out = np.full((n_rows, x.shape[1]), -np.inf)
    at = np.flatnonzero(np.diff(row, prepend=-1))
    out[row[at]] = np.logaddexp.reduceat(x, at, axis=0)
    return out


def _fit(rows, rounds: int, rate: float, decay: float, size: int) -> Model:
    """Gradient ascent with momentum and scaled steps; forward-backward runs over all rows at once, one
    token position after the other. Rows are padded on the left of the lattice by
    their own length: position ``size`` is every row's end."""
    n_rows, types = len(rows), len(KINDS) + 1
    span_row, span_i, span_j, on_span, on_feature = [], [], [], [], []
    outside = np.full((n_rows, size + 1), -1)
    gold_f, gold_o, gold_t = np.zeros((types - 1, N_FEATURES)), np.zeros(OUTSIDE), np.zeros((types, types))
    first = np.zeros(n_rows, int)
    for r, (text, cut, spans, path, index) in enumerate(rows):
        n = len(cut) - 1
        first[r] = size - n
        kinds = [outside_kind(text[a:b]) for a, b in zip(cut, cut[1:])]
        outside[r, first[r]:size] = kinds
        for i, j, on in spans:
            on_span += [len(span_row)] * len(on)
            on_feature += on
            span_row.append(r)
            span_i.append(i + first[r])
            span_j.append(j + first[r])
        ends, at, before = {i: (j, k) for i, j, k in path}, 0, 0
        while at < n:
            j, k = ends.get(at, (at + 1, -1))
            gold_t[before, k + 1] += 1
            if k >= 0:
                gold_f[k, spans[index[at, j]][2]] += 1
            else:
                gold_o[kinds[at]] += 1
            at, before = j, k + 1
    span_row, span_i, span_j = map(np.array, (span_row, span_i, span_j))
    on = np.zeros((len(span_row), N_FEATURES), np.float32)
    on[on_span, on_feature] = 1
    into = [np.flatnonzero(span_j == j) for j in range(size + 1)]
    from_ = [np.flatnonzero(span_i == i) for i in range(size + 1)]
    w, o, t = np.zeros((types - 1, N_FEATURES)), np.zeros(OUTSIDE), np.zeros((types, types))
    speed, grown = [np.zeros_like(x) for x in (w, o, t)], [np.zeros_like(x) for x in (w, o, t)]
    for turn in range(1, rounds + 1):
        score = on @ w.T.astype(np.float32)
        fwd = np.full((size + 1, n_rows, types), -np.inf)
        fwd[first, np.arange(n_rows), 0] = 0
        single = np.where(outside >= 0, o[outside], -np.inf)
        for j in range(1, size + 1):
            step = np.logaddexp.reduce(fwd[j - 1] + t[:, 0], axis=1) + single[:, j - 1]
            fwd[j, :, 0] = np.logaddexp(fwd[j, :, 0], step)
            k = into[j]
            if len(k):
                came = np.logaddexp.reduce(fwd[span_i[k], span_row[k]][:, :, None] + t[None, :, 1:], axis=1) + score[k]
                fwd[j, :, 1:] = by_row(came, span_row[k], n_rows)
        bwd = np.full((size + 1, n_rows, types), -np.inf)
        bwd[size] = 0
        for i in range(size - 1, -1, -1):
            acc = t[None, :, 0] + (single[:, i] + bwd[i + 1, :, 0])[:, None]
            k = from_[i]
            if len(k):
                went = np.logaddexp.reduce(t[None, :, 1:] + (score[k] + bwd[span_j[k], span_row[k], 1:])[:, None, :], axis=2)
                acc = np.logaddexp(acc, by_row(went, span_row[k], n_rows))
            bwd[i] = acc
        whole = np.logaddexp.reduce(fwd[size], axis=1)
        # Expected counts of features and transitions.
        edge = fwd[span_i, span_row][:, :, None] + t[None, :, 1:] + (score + bwd[span_j, span_row, 1:])[:, None, :]
        prob = np.exp(edge - whole[span_row][:, None, None])
        e_w, e_t, e_o = prob.sum(axis=1).T @ on, np.zeros((types, types)), np.zeros(OUTSIDE)
        e_t[:, 1:] = prob.sum(axis=0)
        for i in range(size):
            p = np.exp(fwd[i] + t[None, :, 0] + (single[:, i] + bwd[i + 1, :, 0] - whole)[:, None])
            e_t[:, 0] += p.sum(axis=0)
            e_o += np.bincount(np.maximum(outside[:, i], 0), p.sum(axis=1), OUTSIDE)
        for x, v, g, gold, e in zip((w, o, t), speed, grown, (gold_f, gold_o, gold_t), (e_w, e_o, e_t)):
            grad = (gold - e) / n_rows - decay * x
            v += 0.1 * (grad - v)
            g += 0.01 * (grad * grad - g)
            x += rate * (v / (1 - 0.9 ** turn)) / (np.sqrt(g / (1 - 0.99 ** turn)) + 1e-8)
    return Model(w, o, t)


def annotate(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``id``, ``base`` and ``region`` (packed spans; region texts beside) per row."""
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        base, starts, parts = [], [], []
        for t in b.column(1).to_pylist():
            base.append([x for s in base_spans(t) for x in s])
            where = regions(t)
            starts.append([lo for lo, _ in where])
            parts.append([t[lo:hi] for lo, hi in where])
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(base, pa.list_(pa.int32())), pa.array(starts, pa.list_(pa.int32())),
                                           pa.array(parts, pa.list_(pa.string()))], ["id", "base", "starts", "regions"])

    return map_batches(rows, run, f"id {rows.schema['id'].dataType.simpleString()}, base array<int>, starts array<int>, "
                                  "regions array<string>")


def fit(annotated: DataFrame, sample: int = SAMPLE) -> Model | None:
    """Train on the ``sample`` different regions of smallest hash (at most 96 tokens
    long); that many short strings are all the driver gets."""
    r = (annotated.select(F.explode("regions").alias("region"))
         .where(F.length("region") <= 6 * CONTEXT).distinct()
         .select("region", F.xxhash64("region").alias("h")).orderBy("h", "region").limit(sample))
    return train([(x.region, base_spans(x.region)) for x in r.collect()])


def added_spans(model: Model | None, base: list[tuple[int, int, int]], starts, parts, min_prob: float):
    """Spans of the model that meet no base span."""
    if model is None:
        return []
    taken = sorted((s, e) for _, s, e in base)
    out = []
    for lo, part in zip(starts, parts):
        for kind, s, e in model.find(part, min_prob):
            s, e = s + lo, e + lo
            if all(e <= a or s >= z for a, z in taken):
                out.append((kind, s, e))
    return out


def triples(flat) -> list[tuple[int, int, int]]:
    return list(zip(flat[::3], flat[1::3], flat[2::3]))


def joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))


def find_pii(df: DataFrame, id_col: str = "doc_id", text: str = "text", sample: int = SAMPLE,
             min_prob: float = 0.9) -> DataFrame:
    """``id``, ``n_email``, ``n_ip``, ``n_card``, ``n_phone`` (base spans), ``base``
    and ``spans`` (base and added, ``kind:start:end`` comma-joined) per row."""
    found = store(annotate(df, id_col, text), "pii")
    model = fit(found, sample)

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        counts, bases, spans = [], [], []
        for row in b.to_pylist():
            base = triples(row["base"])
            counts.append([sum(k == n for k, _, _ in base) for n in range(len(KINDS))])
            bases.append(joined(base))
            spans.append(joined(base + added_spans(model, base, row["starts"], row["regions"], min_prob)))
        return pa.RecordBatch.from_arrays(
            [b.column(0)] + [pa.array([c[n] for c in counts], pa.int64()) for n in range(len(KINDS))]
            + [pa.array(bases), pa.array(spans)], ["id", *(f"n_{k}" for k in KINDS), "base", "spans"])

    return map_batches(found, run, f"id {found.schema['id'].dataType.simpleString()}, n_email long, n_ip long, n_card long, "
                                   "n_phone long, base string, spans string")


def mask_text(text: str, spans) -> str:
    """Each span replaced by its kind in angle brackets; of overlapping spans the
    first (the longer of two with one start) names the whole stretch."""
    out, at = [], 0
    for s, e, k in sorted((s, -e, k) for k, s, e in spans):
        if s >= at:
            out += [text[at:s], f"<{KINDS[k].upper()}>"]
        at = max(at, -e)
    return "".join(out) + text[at:]


def mask_pii(df: DataFrame, id_col: str = "doc_id", text: str = "text", sample: int = SAMPLE,
             min_prob: float = 0.9) -> DataFrame:
    """``df`` with every span in ``text`` replaced by ``<KIND>``."""
    found = store(annotate(df, id_col, text), "pii")
    model = fit(found, sample)

    @F.pandas_udf("string")
    def masked(texts):
        import pandas as pd

        out = []
        for t in texts:
            base = base_spans(t)
            where = regions(t)
            spans = base + added_spans(model, base, [lo for lo, _ in where], [t[lo:hi] for lo, hi in where], min_prob)
            out.append(mask_text(t, spans) if spans else t)
        return pd.Series(out, dtype=object)

    return df.withColumn(text, F.when(F.col(text).isNotNull(), masked(F.coalesce(F.col(text), F.lit("")))))
