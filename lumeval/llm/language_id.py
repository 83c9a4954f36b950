"""Language identification with a bidirectional gated recurrent network over bytes.

``fit`` trains the network in NumPy by backpropagation through time on a bounded,
documented sample of labelled texts; ``predict`` labels every byte of every whole
text and pools the probabilities of a text.

Defined results: null text, empty text and text without a letter are ``und`` with
score 0; without any labelled training row every text is ``und``; repeated rows are
predicted row by row; ids may repeat or be null (a null id is neither learned from
nor held out); other columns, whatever their names, are never read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, id_bucket, text_bytes

UND = "und"
#: Bounds of the training sample: texts of a language, bytes of a text's window.
SAMPLE_PER_LANG = 500
SAMPLE_BYTES = 128
HIDDEN = 8
WINDOW = 96  # bytes that the network reads at once, forwards and backwards


class Network:
    """One gated recurrent layer in each direction and a softmax at every byte.

    For direction d: a = X[byte] + U h (+ b within X), r, z = gate(a_r), gate(a_z),
    n = squash(X_n + r * (U_n h)), h' = n + z * (h - n).  The gate is the piecewise linear
    sigmoid and squash the rational tanh x (27 + x^2) / (27 + 9 x^2) on [-3, 3]: both need
    only cheap arithmetic on every byte, and training uses the same functions.
    """

    def __init__(self, n_classes: int, hidden: int = HIDDEN, seed: int = 7):
        g = np.random.default_rng(seed)
        f32 = np.float32
        self.p = {}
        for d in "fb":
            self.p["X" + d] = g.normal(0, 0.3, (256, 3 * hidden)).astype(f32)
            self.p["U" + d] = g.normal(0, 0.8 / np.sqrt(hidden), (hidden, 3 * hidden)).astype(f32)
            self.p["V" + d] = g.normal(0, 0.3, (hidden, n_classes)).astype(f32)
        self.p["c"] = np.zeros(n_classes, f32)
        self.hidden = hidden

    def loss_and_grads(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray):
        """x: (batch, time) bytes; mask: same shape, 1 where a byte stands; y: class of each row."""
        p, H = self.p, self.hidden
        B, T = x.shape
        # both directions at once, features before rows: the second reads the reversed rows, padding first
        X, U = np.stack([p["Xf"], p["Xb"]]), np.stack([p["Uf"], p["Ub"]])
        byte = np.stack([x, x[:, ::-1]]).transpose(2, 0, 1).astype(np.intp) + np.array([0, 256])[:, None]
        on = np.stack([mask, mask[:, ::-1]]).transpose(2, 0, 1)[:, :, None]
        a = np.ascontiguousarray(X.reshape(512, 3 * H)[byte].swapaxes(2, 3))
        up = U.transpose(0, 2, 1).copy()
        hs = np.zeros((T + 1, 2, H, B), X.dtype)
        gate, un = np.empty((T, 2, 2 * H, B), X.dtype), np.empty((T, 2, H, B), X.dtype)
        v, n = np.empty_like(un), np.empty_like(un)
        for t in range(T):
            h, u = hs[t], np.matmul(up, hs[t])
            gate[t] = np.clip(0.5 + 0.25 * (a[t, :, :2 * H] + u[:, :2 * H]), 0, 1)
            un[t] = u[:, 2 * H:]
            v[t] = w = np.clip(a[t, :, 2 * H:] + gate[t, :, :H] * un[t], -3, 3)
            q = w * w
            n[t] = w * (27 + q) / (27 + 9 * q)
            hs[t + 1] = np.where(on[t] > 0, n[t] + gate[t, :, H:] * (h - n[t]), h)
        states = {"f": hs[1:, 0].swapaxes(1, 2).copy(), "b": hs[:0:-1, 1].swapaxes(1, 2).copy()}
        logits = p["c"] + states["f"] @ p["Vf"] + states["b"] @ p["Vb"]  # (time, batch, classes)
        e = np.exp(logits - logits.max(-1, keepdims=True))
        prob = e / e.sum(-1, keepdims=True)
        total, row = mask.sum(), np.arange(B)
        loss = -(np.log(prob[:, row, y] + 1e-12) * mask.T).sum() / total
        dl = prob
        dl[:, row, y] -= 1
        dl = dl * (mask.T[:, :, None] / total)
        grads = {"c": dl.sum((0, 1))}
        for d in "fb":
            grads["V" + d] = states[d].reshape(T * B, H).T @ dl.reshape(T * B, -1)
        out = np.stack([dl @ p["Vf"].T, (dl @ p["Vb"].T)[::-1]], 1).swapaxes(2, 3).copy()
        slope = 0.25 * ((gate > 0) & (gate < 1)).astype(X.dtype)
        r, z, q = gate[:, :, :H], gate[:, :, H:], v * v
        to_r, to_z = un * slope[:, :, :H], (hs[:-1] - n) * slope[:, :, H:]
        to_n = (1 - z) * (9 * ((q - 9) / (27 + 9 * q)) ** 2)
        da, du = np.empty_like(a), np.empty_like(a)
        back = np.zeros((2, H, B), X.dtype)
        for t in range(T - 1, -1, -1):
            dh = back + out[t]
            dnew = dh * on[t]
            dn = dnew * to_n[t]
            da[t, :, :H], da[t, :, H:2 * H], da[t, :, 2 * H:] = dn * to_r[t], dnew * to_z[t], dn
            du[t, :, :2 * H], du[t, :, 2 * H:] = da[t, :, :2 * H], dn * r[t]
            back = dh - dnew + dnew * z[t] + np.matmul(U, du[t])
        flat = byte.ravel()
        order = np.argsort(flat, kind="stable")
        first = np.flatnonzero(np.diff(flat[order], prepend=-1))
        dX = np.zeros((512, 3 * H), X.dtype)
        dX[flat[order][first]] = np.add.reduceat(da.swapaxes(2, 3).reshape(-1, 3 * H)[order], first, axis=0)
        for i, d in enumerate("fb"):
            grads["X" + d] = dX[256 * i:256 * i + 256]
            grads["U" + d] = np.matmul(hs[:-1, i], du[:, i].swapaxes(1, 2)).sum(0)
        return loss, grads

    def train(self, rows: list[tuple[bytes, int]], steps: int = 260, batch: int = 96, seed: int = 11, rate=0.02):
        """Adam on random batches with as many rows of each class; gradients are clipped by norm."""
        g = np.random.default_rng(seed)
        by = {}
        for b, y in rows:
            by.setdefault(y, []).append(np.frombuffer(b, np.uint8))
        keys = sorted(by)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v2 = {k: np.zeros_like(v) for k, v in self.p.items()}
        for step in range(1, steps + 1):
            x = np.zeros((batch, WINDOW), np.uint8)
            mask = np.zeros((batch, WINDOW), np.float32)
            y = np.array([keys[((step - 1) * batch + i) % len(keys)] for i in range(batch)])
            for i in range(batch):
                pool = by[y[i]]
                b = pool[g.integers(len(pool))]
                at = g.integers(max(1, len(b) - WINDOW + 1))
                b = b[at:at + WINDOW]
                x[i, :len(b)], mask[i, :len(b)] = b, 1
            loss, grads = self.loss_and_grads(x, mask, y)
            norm = np.sqrt(sum(float((v * v).sum()) for v in grads.values()))
            lr = rate * min(1.0, 2.0 * (1 - step / (steps + 1)))
            for k, gr in grads.items():
                gr = gr * min(1.0, 1.0 / (norm + 1e-9))
                m[k] = 0.9 * m[k] + 0.1 * gr
                v2[k] = 0.99 * v2[k] + 0.01 * gr * gr
                step_k = lr * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v2[k] / (1 - 0.99 ** step)) + 1e-8)
                self.p[k] = (self.p[k] - step_k).astype(np.float32)
        return self

    def frozen(self) -> dict:
        """Weights laid out for ``label``: features first, the gates' 0.5 + 0.25 a folded in."""
        H, out = self.hidden, {"H": self.hidden, "c": self.p["c"][:, None].copy()}
        for d in "fb":
            X, U = self.p["X" + d].T.copy(), self.p["U" + d].T.copy()
            X[:2 * H] = 0.5 + 0.25 * X[:2 * H]
            U[:2 * H] *= 0.25
            out["X" + d], out["U" + d], out["V" + d] = X, U, self.p["V" + d].T.copy()
        return out


def label(model: dict, x: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Class probabilities of every byte: x (time, rows), rows' lengths -> (time, classes, rows)."""
    H, (T, N) = model["H"], x.shape
    logits = np.empty((T, len(model["c"]), N), np.float32)
    full = bool((length == T).all())
    for d in "fb":
        X, U, V = model["X" + d], model["U" + d], model["V" + d]
        h, a = np.zeros((H, N), np.float32), np.empty((3 * H, N), np.float32)
        u, q, w = np.empty_like(a), np.empty_like(h), np.empty_like(h)
        gate, r, z, n, un = a[:2 * H], a[:H], a[H:2 * H], a[2 * H:], u[2 * H:]
        for t in range(T) if d == "f" else range(T - 1, -1, -1):
            np.take(X, x[t], axis=1, out=a, mode="clip")
            np.matmul(U, h, out=u)
            gate += u[:2 * H]
            np.clip(gate, 0, 1, out=gate)
            un *= r
            n += un
            np.clip(n, -3, 3, out=n)
            np.multiply(n, n, out=q)
            np.add(q, 27, out=w)
            n *= w
            q *= 9
            q += 27
            n /= q
            h -= n
            h *= z
            h += n
            if d == "b" and not full:
                h[:, length <= t] = 0  # the backward state starts at the text's last byte
            if d == "f":
                np.add(V @ h, model["c"], out=logits[t])
            else:
                logits[t] += V @ h
    logits -= logits.max(1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(1, keepdims=True)
    return logits


def pooled(model: dict, data: np.ndarray, off: np.ndarray, rows: int = 2048) -> np.ndarray:
    """Mean class probabilities over all bytes of each text: (texts, classes)."""
    sizes = np.diff(off)
    tiles = -(-sizes // WINDOW)
    owner = np.repeat(np.arange(len(sizes)), tiles)
    k = np.arange(len(owner)) - np.repeat(np.cumsum(tiles) - tiles, tiles)
    start = off[:-1][owner] + k * WINDOW
    length = np.minimum(WINDOW, off[1:][owner] - start)
    order = np.argsort(-length, kind="stable")  # full windows first: most blocks need no mask
    total = np.zeros((len(sizes), len(model["c"])))
    at = np.arange(WINDOW)
    for i in range(0, len(order), rows):
        pick = order[i:i + rows]
        idx = np.minimum(start[pick][None, :] + at[:, None], len(data) - 1)
        prob = label(model, data[idx].astype(np.intp), length[pick])
        if length[pick[-1]] < WINDOW:
            prob *= (at[:, None] < length[pick][None, :])[:, None, :]
        np.add.at(total, owner[pick], prob.sum(0).T)
    return total / np.maximum(sizes, 1)[:, None]


def scrambled(texts: list[bytes], seed: int = 13) -> list[bytes]:
    """Texts of no language: the characters of each in another order, or letters that the texts use, drawn evenly."""
    g = np.random.default_rng(seed)
    known = [b.decode("utf-8", "ignore") for b in texts]
    letters = sorted({c for t in known for c in t if c.isalpha()} | set("abcdefghijklmnopqrstuvwxyz"))
    out = []
    for i, t in enumerate(known):
        chars = [c if c.isspace() or i % 2 else letters[g.integers(len(letters))] for c in t]
        if i % 2:
            g.shuffle(chars)
        out.append("".join(chars).encode())
    return out


def fit(train: DataFrame, text: str, lang: str, key: str, per_lang: int = SAMPLE_PER_LANG,
        sample_bytes: int = SAMPLE_BYTES, reject: bool = False) -> tuple[list[str], dict | None]:
    """Languages and weights learned from ``train``.

    ``reject`` adds ``und`` as the last language, learned from scrambled texts of the sample.

    The sample is bounded: about ``per_lang`` texts of each language, chosen by a hash of the
    key, and of each a window of ``sample_bytes`` bytes.  Counting the languages reads all rows.
    """
    good = train.filter(F.col(text).rlike(r"\p{L}") & F.col(lang).isNotNull() & F.col(key).isNotNull())
    counts = {r[0]: r[1] for r in good.groupBy(F.col(lang)).count().collect()}
    if not counts:
        return [], None
    langs = sorted(counts)
    share = F.create_map(*[F.lit(v) for k in langs for v in (k, min(1.0, 1.2 * per_lang / counts[k]))])
    draw = (F.xxhash64(F.col(key).cast("string"), F.lit("draw")).cast("double") / F.lit(2.0 ** 64) + 0.5)
    raw = F.col(text).cast("binary")
    at = F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit("at")),
                F.greatest(F.lit(1), F.octet_length(text) - sample_bytes + 1)).cast("int")
    rows = (good.filter(draw < share[F.col(lang)])
            .select(F.col(lang).alias("l"), F.substring(raw, at + 1, F.lit(sample_bytes)).alias("b"), draw.alias("d"))
            .collect())
    seen: dict[str, int] = {}
    sample = []
    for r in sorted(rows, key=lambda r: (r["l"], r["d"], bytes(r["b"]))):
        seen[r["l"]] = seen.get(r["l"], 0) + 1
        if seen[r["l"]] <= per_lang and len(r["b"]):
            sample.append((bytes(r["b"]), langs.index(r["l"])))
    if reject:
        none = [b for b in scrambled([b for b, _ in sample]) if b]
        langs, sample = [*langs, UND], sample + [(b, len(langs)) for b in none]
    return langs, Network(len(langs)).train(sample).frozen()


def predict(df: DataFrame, text: str, langs: list[str], model: dict | None, keep: list[str]) -> DataFrame:
    """``keep`` columns plus lang_pred and score for every row of ``df``."""
    letters = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    src = df.select(*[F.col(c) for c in keep], F.when(letters, F.col(text)).alias("__text"))
    if model is None:
        return src.select(*keep, F.lit(UND).alias("lang_pred"), F.lit(0.0).alias("score"))
    schema = src.drop("__text").schema.add("lang_pred", "string").add("score", "double")

    def run(it):
        names = np.array(langs, dtype=object)
        for batch in batches(it, "__text"):
            col = batch.column(batch.schema.get_field_index("__text"))
            data, off = text_bytes(col)
            some = np.diff(off) > 0
            pred, score = np.full(len(some), UND, object), np.zeros(len(some))
            if some.any():
                prob = pooled(model, data, off)
                best = prob.argmax(1)
                pred[some] = names[best[some]]
                score[some] = np.clip(prob[np.arange(len(best)), best][some], 0, 1)
            rest = [batch.column(i) for i in range(batch.num_columns) if batch.schema.names[i] != "__text"]
            yield pa.RecordBatch.from_arrays(
                [*rest, pa.array(pred.tolist(), pa.string()), pa.array(score)],
                names=[*[n for n in batch.schema.names if n != "__text"], "lang_pred", "score"])

    return src.mapInArrow(run, schema)


def identify(docs: DataFrame, fold: int = 0, folds: int = 5) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of ``docs`` (doc_id, text, lang)."""
    src = docs.select("doc_id", "text", "lang", F.coalesce(id_bucket("doc_id", folds) == fold, F.lit(False))
                      .alias("held_out"))
    langs, model = fit(src.filter(~F.col("held_out")), "text", "lang", "doc_id")
    return predict(src, "text", langs, model, ["doc_id", "held_out"])
