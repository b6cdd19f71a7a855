"""Secret scan: fixed patterns, and a character convolutional network over all other candidates.

A candidate is any run of token characters that is long enough. The network sees its characters and
those around it. It is trained on all of the corpus's own labelled findings: values that a fixed
pattern found are positive, all other candidates negative; both also appear with their surroundings
blanked, so that the form of the value counts and not its keyword alone. Tasks train on one share of
the findings each, beginning from common parameters, and what they arrive at is averaged. A fourth of
the findings, kept apart, calibrates the network: tasks score them and count them by score.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import keyed_rows, map_slices, narrow, row_key, with_text, written

_ASSIGN = re.compile(
    r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.ASCII | re.IGNORECASE,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{12,}={0,2}")
_DIGIT = re.compile(r"[0-9]")
KINDS = ("assign", "access", "hex")
MODEL = "model"

LEFT, BODY, RIGHT = 24, 40, 8
WINDOW = LEFT + BODY + RIGHT
#: Characters that the convolution spans. Windows of a long candidate overlap by one less.
WIDTH = 5
#: Windows in one share of the findings, and rounds in which all shares are trained on and averaged.
SHARE = 20_000
ROUNDS = 2
#: Windows of one step, and those that the first share is shown before the rounds.
STEP, SHOWN = 64, 24_000
#: Logits count in steps of one ``GRAIN``th up to ``MOST``, so that all scores are a bounded table.
GRAIN, MOST = 1024, 60.0
#: Share of the findings kept apart that a threshold must recall.
RECALL = 0.98

SPAN = "struct<start:int,end:int,kind:string>"
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))
_SEEN = pa.list_(
    pa.struct(
        [
            ("start", pa.int32()),
            ("end", pa.int32()),
            ("window", pa.binary()),
            ("label", pa.int32()),
            ("digit", pa.bool_()),
        ]
    )
)


def base_spans(text: str) -> list[tuple[int, int, str, int]]:
    """(start, kind number, end, start of the value) of every fixed finding, by start and kind."""
    found = []
    if "=" in text or ":" in text:
        for m in _ASSIGN.finditer(text):
            if m.end(1) - m.start(1) >= 6:
                found.append((m.start(), 0, m.end(), m.start(1)))
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m.start()) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end(), m.start()) for m in _HEX.finditer(text)]
    return sorted(found)


def windows_of(text: str, start: int, end: int) -> bytes:
    """The characters before, in and after a candidate; others than ASCII are 0x7F, none is 0.

    A longer candidate has as many windows as it needs, so that each place of the convolution lies in
    one of them; the first has what stands before it, the last what stands after it.
    """
    out = []
    for at in range(start, max(end - WIDTH + 1, start + 1), BODY - WIDTH + 1):
        last = at + BODY >= end
        left = text[max(0, start - LEFT) : start] if at == start else ""
        out.append(left.rjust(LEFT, "\0") + text[at : min(end, at + BODY)].ljust(BODY, "\0"))
        out.append((text[end : end + RIGHT] if last else "").ljust(RIGHT, "\0"))
        if last:
            break
    return bytes(c if c < 128 else 127 for c in map(ord, "".join(out)))


def scan(text: str) -> tuple[list[dict], list[dict]]:
    """The fixed spans of a text, and its labelled candidates."""
    base = base_spans(text)
    spans = [{"start": a, "end": b, "kind": KINDS[k]} for a, k, b, _ in base]

    def candidate(start: int, end: int, label: int) -> dict:
        digit = bool(_DIGIT.search(text, start, end))
        return {"start": start, "end": end, "window": windows_of(text, start, end), "label": label, "digit": digit}

    seen = [candidate(v, b, 1) for _, _, b, v in base]
    at = 0  # base spans are sorted by start, candidates come in order
    for m in _CANDIDATE.finditer(text):
        while at < len(base) and base[at][2] <= m.start():
            at += 1
        if at == len(base) or base[at][0] >= m.end():
            seen.append(candidate(*m.span(), 0))
    return spans, seen


class CharCNN:
    """Embedding by segment and character, one convolution, max pooling, one logit.

    The pool is over all places of all windows of a candidate.
    """

    def __init__(self, filters: int = 24, dims: int = 8, width: int = WIDTH, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        self.width, self.dims = width, dims
        self.table = rng.normal(0, 0.3, (3 * 128, dims))
        self.kernel = rng.normal(0, (width * dims) ** -0.5, (width * dims, filters))
        self.bias = np.zeros(filters)
        self.weight = rng.normal(0, filters**-0.5, filters)
        self.offset = np.zeros(1)
        self.scale, self.shift, self.threshold = 1.0, 0.0, 1.0
        self.segment = np.repeat([0, 128, 256], [LEFT, BODY, RIGHT])

    def _maps(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the characters, and every filter at every place."""
        ids = codes.astype(np.int64) + self.segment
        places = ids.shape[1] - self.width + 1
        maps = np.zeros((len(ids), places, len(self.bias)))
        for i, part in enumerate(self.kernel.reshape(self.width, self.dims, -1)):
            each = self.table @ part + self.bias / self.width  # what a character adds at this place
            maps += np.take(each, ids[:, i : i + places], axis=0, mode="clip")
        return ids, maps

    def logits(self, codes: np.ndarray, sizes: np.ndarray | None = None) -> np.ndarray:
        """One number for each candidate; ``sizes`` has its number of windows, one if not given."""
        parts = [np.maximum(self._maps(codes[i : i + STEP])[1].max(1), 0) for i in range(0, len(codes), STEP)]
        pooled = np.concatenate([*parts, np.zeros((0, len(self.weight)))])
        if sizes is not None and len(sizes):
            pooled = np.maximum.reduceat(pooled, np.cumsum(sizes) - sizes)
        return pooled @ self.weight + self.offset

    def bins(self, codes: np.ndarray, sizes: np.ndarray | None = None) -> np.ndarray:
        """The logits in whole grains."""
        return np.rint(np.clip(self.logits(codes, sizes), -MOST, MOST) * GRAIN).astype(np.int64)

    def _calibrated(self, logits: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * logits + self.shift, -50, 50)))

    def probability(self, codes: np.ndarray, sizes: np.ndarray | None = None) -> np.ndarray:
        return self._calibrated(self.bins(codes, sizes) / GRAIN)

    def _gradients(self, codes: np.ndarray, labels: np.ndarray, weights: np.ndarray):
        ids, maps = self._maps(codes)
        top = maps.argmax(1)
        pooled = np.maximum(np.take_along_axis(maps, top[:, None], 1)[:, 0], 0)
        logit = pooled @ self.weight + self.offset
        error = (1 / (1 + np.exp(-np.clip(logit, -50, 50))) - labels) * weights / len(labels)
        to_pool = error[:, None] * self.weight * (pooled > 0)
        # The characters under each filter's maximum, and what they are in the table.
        under = ids[np.arange(len(codes))[:, None, None], top[:, :, None] + np.arange(self.width)]
        chosen = self.table[under].reshape(*top.shape, -1)
        to_kernel = np.einsum("nfd,nf->df", chosen, to_pool)
        to_patch = to_pool[:, :, None] * self.kernel.T
        cells = under[..., None] * self.dims + np.arange(self.dims)
        to_table = np.bincount(cells.reshape(-1), to_patch.reshape(-1), self.table.size).reshape(self.table.shape)
        return to_table, to_kernel, to_pool.sum(0), pooled.T @ error, error.sum(keepdims=True)

    @property
    def values(self) -> list[np.ndarray]:
        return [self.table, self.kernel, self.bias, self.weight, self.offset]

    def flat(self) -> np.ndarray:
        """All parameters in one row."""
        return np.concatenate([v.reshape(-1) for v in self.values])

    def take(self, flat: np.ndarray) -> None:
        """Parameters from one row."""
        at = 0
        for v in self.values:
            v[...] = flat[at : at + v.size].reshape(v.shape)
            at += v.size

    def fit(
        self, codes: np.ndarray, labels: np.ndarray, weights: np.ndarray, epochs: int = 4, rate: float = 0.01
    ) -> None:
        """Adam on the logistic loss."""
        rng = np.random.default_rng(11)
        first, second = ([np.zeros_like(v) for v in self.values] for _ in range(2))
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(codes))
            for at in range(0, len(order), STEP):
                pick, step = order[at : at + STEP], step + 1
                for v, m, s, g in zip(
                    self.values, first, second, self._gradients(codes[pick], labels[pick], weights[pick]), strict=True
                ):
                    m += 0.1 * (g - m)
                    s += 0.001 * (g * g - s)
                    v -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)

    def calibrate(self, bins: np.ndarray, labels: np.ndarray, times: np.ndarray, recall: float = RECALL) -> None:
        """Platt scaling, then a threshold that recalls enough of the positives.

        ``times``: how many findings have this bin and label. Of the thresholds from 0.5 on, the one
        of the best precision, and the lowest if several are.
        """
        x = bins / GRAIN
        n1, n0 = (times[labels == y].sum() for y in (1, 0))
        goal = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
        design, beta = np.column_stack([x, np.ones_like(x)]), np.array([1.0, 0.0])

        def loss(at: np.ndarray) -> float:
            return float(times @ (np.logaddexp(0, design @ at) - goal * (design @ at)))

        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(design @ beta, -50, 50)))
            hessian = design.T @ (design * (times * (p * (1 - p) + 1e-9))[:, None]) + 1e-6 * np.eye(2)
            step = np.clip(np.linalg.solve(hessian, design.T @ (times * (p - goal))), -2, 2)
            while loss(beta - step) > loss(beta) and np.abs(step).max() > 1e-9:
                step /= 2
            beta = beta - step
        self.scale, self.shift = max(float(beta[0]), 1e-3), float(beta[1])
        found = self._calibrated(x)
        order = np.argsort(found, kind="stable")
        (good, n_good), (bad, n_bad) = (
            (found[order][labels[order] == y], np.append(0, np.cumsum(times[order][labels[order] == y]))) for y in (1, 0)
        )
        highest = good[np.searchsorted(n_good[1:], int((1 - recall) * n1), side="right")]
        tries = np.unique(np.append(np.nextafter(bad, 2.0), 0.5))
        tries = tries[(tries >= 0.5) & (tries <= highest)]
        hits = n1 - n_good[np.searchsorted(good, tries)]
        misses = n0 - n_bad[np.searchsorted(bad, tries)]
        precision = hits / (hits + misses)
        self.threshold = float(tries[precision.argmax()]) if len(tries) else float(max(highest, 0.5))


def _sizes(windows: list[bytes]) -> np.ndarray:
    return np.array([len(w) // WINDOW for w in windows], np.int64)


def _codes(windows: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(windows), np.uint8).reshape(-1, WINDOW)


def _blanked(codes: np.ndarray) -> np.ndarray:
    bare = codes.copy()
    bare[:, :LEFT] = bare[:, LEFT + BODY :] = 0
    return bare


def _shown(model: CharCNN, windows: list[bytes], labels: np.ndarray, weights: dict[int, float], epochs: int) -> None:
    """Train on findings, as they are and with their surroundings blanked; ``weights`` by label."""
    codes, each = _codes(windows), np.repeat(labels, _sizes(windows))
    heavy = np.where(each == 1, weights[1], weights[0])
    model.fit(np.concatenate([codes, _blanked(codes)]), np.tile(each, 2), np.tile(heavy, 2), epochs)


def _epochs(size: int) -> int:
    """How often the first share is shown, by its windows.

    Secrets that no fixed pattern finds are among the negatives. A network that is shown them more
    often learns them by heart.
    """
    return min(max(SHOWN // max(size, 1), 2), 4)


def train(findings: list[tuple[bytes, int]], recall: float = RECALL) -> CharCNN | None:
    """A network from (window, label) findings that are one share; None if one of the classes is missing."""
    labels = np.array([y for _, y in findings], np.float64)
    if len(set(labels.tolist())) < 2:
        return None
    apart = np.arange(len(labels)) % 4 == 0
    if len(set(labels[apart].tolist())) < 2 or len(set(labels[~apart].tolist())) < 2:
        apart = np.zeros(len(labels), bool)
    windows = [w for w, _ in findings]
    rest = [w for w, aside in zip(windows, apart.tolist(), strict=True) if not aside]
    sizes = _sizes(rest)
    share = np.average(labels[~apart], weights=sizes)
    model = CharCNN()
    _shown(model, rest, labels[~apart], {1: 0.5 / share, 0: 0.5 / (1 - share)}, _epochs(int(sizes.sum())))
    held = apart if apart.any() else ~apart
    kept = [w for w, aside in zip(windows, held.tolist(), strict=True) if aside]
    model.calibrate(model.bins(_codes(kept), _sizes(kept)), labels[held], np.ones(int(held.sum())), recall)
    return model


def _trained(shares: DataFrame, model: CharCNN, weights: dict[int, float], epochs: int) -> np.ndarray:
    """The mean of the parameters that tasks arrive at on one share each, weighted by its windows."""
    shared = shares.sparkSession.sparkContext.broadcast(model.flat())

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def fitted() -> pa.RecordBatch:
            mine = CharCNN()
            mine.take(shared.value)
            _shown(mine, windows, np.array(labels, np.float64), weights, epochs)
            size = sum(map(len, windows)) / WINDOW
            flat = mine.flat()
            columns = [pa.array(np.arange(len(flat))), pa.array(flat * size), pa.array(np.full(len(flat), size))]
            return pa.RecordBatch.from_arrays(columns, names=["at", "value", "size"])

        share, windows, labels = None, [], []
        for batch in batches:
            for row in batch.to_pylist():
                if row["share"] != share:
                    if windows:
                        yield fitted()
                    share, windows, labels = row["share"], [], []
                windows.append(row["window"])
                labels.append(row["label"])
        if windows:
            yield fitted()

    fits = shares.select("share", "window", "label").mapInArrow(fit, "at long, value double, size double")
    mean = fits.groupBy("at").agg((F.sum("value") / F.sum("size")).alias("value")).orderBy("at").toArrow()
    return mean["value"].to_numpy()


def learn(findings: DataFrame, recall: float = RECALL) -> CharCNN | None:
    """A network from all rows ``window, label, o``; None if one of the classes is missing.

    ``o`` is a hash that tells findings apart: by it a fourth is kept apart for the calibration, and
    the others are dealt to shares. The rarer label is shown several times, so that it is a fifth of
    what a share sees; both labels weigh alike. The first share makes the network that the rounds
    begin from; each round goes through all shares.
    """
    windows = F.length("window") / WINDOW
    aside = F.pmod("o", F.lit(4)) == 0
    sums = findings.groupBy("label", aside.alias("apart")).agg(F.sum(windows).alias("n")).collect()
    size = {(r["label"], r["apart"]): r["n"] for r in sums}
    if len({y for y, _ in size}) < 2:
        return None
    if len(size) < 4:  # too few to keep some apart
        aside = F.lit(None)
        size = {(y, False): size.get((y, False), 0) + size.get((y, True), 0) for y in (0, 1)}
    n = {y: size[y, False] for y in (0, 1)}
    turns = {y: max(int(n[1 - y] // (4 * n[y])), 1) for y in (0, 1)}
    rows = {y: n[y] * turns[y] for y in (0, 1)}
    weights = {y: 0.5 * sum(rows.values()) / rows[y] for y in (0, 1)}
    count = int(-(-sum(rows.values()) // SHARE))
    turn = F.explode(F.expr(f"sequence(1, if(label = 1, {turns[1]}, {turns[0]}))")).alias("turn")
    dealt = findings.filter(~F.coalesce(aside, F.lit(False))).select("window", "label", "o", turn)
    dealt = dealt.withColumn("o", F.xxhash64("o", "turn")).drop("turn")
    # By the hash alone: in however many partitions Spark puts them, there are as many shares. Twice
    # as many ranges as shares give each share a task of its own.
    dealt = dealt.withColumn("share", F.pmod(F.hash("o"), F.lit(count))).repartitionByRange(2 * count, "share")
    shares = written(dealt.sortWithinPartitions("share", "o", "window", "label"), "shares")
    model = CharCNN()
    first = shares.agg(F.min("share")).first()[0]
    model.take(_trained(shares.filter(F.col("share") == first), model, weights, _epochs(int(sum(rows.values()) / count))))
    for _ in range(ROUNDS if count > 1 else 0):
        model.take(_trained(shares, model, weights, 1))
    shared = findings.sparkSession.sparkContext.broadcast(model)

    def score(batch: pa.RecordBatch) -> pa.RecordBatch:
        seen = batch["window"].to_pylist()
        found = shared.value.bins(_codes(seen), _sizes(seen))
        return pa.RecordBatch.from_arrays([pa.array(found), batch["label"]], names=["bin", "label"])

    held = findings.filter(F.coalesce(aside, F.lit(True))).select("window", "label")
    table = map_slices(held, score, "bin long, label int").groupBy("bin", "label").count().toArrow()
    model.calibrate(*(table[c].to_numpy().astype(np.float64) for c in ("bin", "label", "count")), recall)
    return model


def secret_spans(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    recall: float = RECALL,
) -> DataFrame:
    """``doc_id, row_key, spans`` for every row.

    ``spans`` are (start, end, kind) in code points, end exclusive, by start and then kind:
    assign, access, hex, and ``model`` for candidates apart from those that the network finds: runs
    of at least 12 characters of ``A-Za-z0-9+/_-``, with or without a digit, read from end to end. All
    findings of both labels train and calibrate it, repeated ones as often as they occur, and every
    candidate of every text is scored. Without findings of both labels there is no network and
    only fixed spans remain. Null and empty texts have no spans; null ids and repeated rows are
    scanned like any other; other columns are ignored.
    """

    def find(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [scan(t or "") for t in batch["text"].to_pylist()]
        return pa.RecordBatch.from_arrays(
            [
                batch["doc_id"],
                batch["row_key"],
                pa.array([f[0] for f in found], _SPANS),
                pa.array([f[1] for f in found], _SEEN),
            ],
            names=["doc_id", "row_key", "spans", "seen"],
        )

    rows = narrow(docs, id_col, text_col).select("doc_id", row_key().alias("row_key"), "text")
    schema = (
        f"doc_id long, row_key long, spans array<{SPAN}>, "
        "seen array<struct<start:int,end:int,window:binary,label:int,digit:boolean>>"
    )
    scanned = written(map_slices(rows, find, schema), "candidates")
    each = scanned.select("row_key", F.explode("seen").alias("s")).select("row_key", "s.*")
    model = learn(each.select("window", "label", F.xxhash64("window", "row_key", "start").alias("o")), recall)
    if model is None:
        return scanned.select("doc_id", "row_key", "spans")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batch: pa.RecordBatch) -> pa.RecordBatch:
        network = shared.value
        spans, seen = batch["spans"].to_pylist(), batch["seen"].to_pylist()
        open_ones = [(n, s) for n, all_seen in enumerate(seen) for s in all_seen if not s["label"]]
        if open_ones:
            windows = [s["window"] for _, s in open_ones]
            p = network.probability(_codes(windows), _sizes(windows))
            for (n, s), good in zip(open_ones, (p >= network.threshold).tolist(), strict=True):
                if good:
                    spans[n].append({"start": s["start"], "end": s["end"], "kind": MODEL})
        rank = {k: i for i, k in enumerate((*KINDS, MODEL))}
        ordered = [sorted(s, key=lambda x: (x["start"], rank[x["kind"]])) for s in spans]
        return pa.RecordBatch.from_arrays(
            [batch["doc_id"], batch["row_key"], pa.array(ordered, _SPANS)],
            names=["doc_id", "row_key", "spans"],
        )

    return map_slices(scanned, score, f"doc_id long, row_key long, spans array<{SPAN}>")


def redact(text: str, spans: list[dict], mark: str = "[SECRET]") -> str:
    """``text`` with each stretch that spans cover replaced by one mark."""
    kept, at = [], 0
    for s in sorted(spans, key=lambda s: s["start"]):
        if s["start"] >= at:
            kept += [text[at : s["start"]], mark]
        at = max(at, s["end"])
    return "".join([*kept, text[at:]])


def redact_secrets(docs: DataFrame, recall: float = RECALL) -> DataFrame:
    """All rows and columns of ``docs``, the secrets in ``text`` replaced by a mark.

    ``n_chars``, if there, follows a text that changed. No row is dropped: null and empty texts stay
    as they are, and rows that are equal in id and text change alike.
    """
    found = secret_spans(docs, recall=recall).filter(F.size("spans") > 0)
    found = found.select("row_key", "spans").dropDuplicates(["row_key"])
    state = keyed_rows(docs).join(found, "row_key", "left").select("row", "spans")

    def clean(batch: pa.RecordBatch) -> pa.RecordBatch:
        pairs = zip(batch["row"].field("text"), batch["spans"].to_pylist(), strict=True)
        texts = [redact(t.as_py(), s) if s else None for t, s in pairs]
        return pa.RecordBatch.from_arrays(
            [batch["row"], pa.array(texts, pa.string())], names=["row", "clean"]
        )

    out = map_slices(state, clean, state.select("row", F.lit(None).cast("string").alias("clean")).schema)
    return with_text(out, docs.columns, F.col("clean"), F.col("clean").isNotNull())
