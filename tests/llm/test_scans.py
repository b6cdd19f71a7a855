"""Secrets and personal data: fixed spans against plain patterns, models on planted values."""

from __future__ import annotations

import hashlib
import random
import re
import string

import pytest
from pyspark.sql import functions as F

from fixtures import awkward, prose, table
from skyledger.llm import pii, queries, secrets
from skyledger.llm.pii import pii_spans, redact_pii
from skyledger.llm.secrets import redact_secrets, secret_spans

ASSIGN = re.compile(
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)


def secret_base(text):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
    return sorted(out)


def luhn(digits):
    values = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(v - 9 * (v > 9) for v in values) % 10 == 0


def pii_base(text):
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        if 14 <= len(digits(m)) <= 19 and luhn(digits(m)):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(digits(m)) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def card(rng):
    body = "".join(rng.choices(string.digits, k=15))
    return next(body + d for d in string.digits if luhn(body + d))


def planted(kind):
    rng = random.Random(8)
    hexa = lambda n: "".join(rng.choices("0123456789abcdef", k=n))
    digits = lambda n: "".join(rng.choices(string.digits, k=n))
    make = {
        "secrets": [
            lambda: f'token = "{hexa(40)}"',
            lambda: f"PassWord:{hexa(12)}",
            lambda: "AKIA" + "".join(rng.choices(string.ascii_uppercase + string.digits, k=16)),
            lambda: f"at {digits(14)} of",
            lambda: f"item-number-{digits(3)}",
        ],
        "pii": [
            lambda: f"a.b{digits(2)}@mail.example.com",
            lambda: f"{rng.randint(0, 255)}.0.{rng.randint(0, 255)}.9",
            lambda: card(rng),
            lambda: f"+1 ({digits(3)}) {digits(3)}-{digits(4)}",
            lambda: f"case {digits(9)} and 2024-01-0{rng.randint(1, 9)} 11",
        ],
    }[kind]
    return [(1000 + i, f"{prose(15, i)} {rng.choice(make)()} {prose(9, 900 + i)}") for i in range(400)]


TRICKY = {
    "secrets": [
        "secret=a.b token:'abcdef' api_key=\"xxxxxx API-KEY=yyyyyyy apikey : zzzzzz ſecret=abcdefg toKen=abcdefg",
        "token=token=password=abcdef passwd=abc passwd=abcdef", "AKIA AKIAAKIA" + "B" * 16 + "c" + "AKIA" + "9" * 15,
        "f" * 23 + " " + "f" * 24 + "g" + "0" * 30, "é\U0001f600 token=abcdef é " + "a1" * 20, "token = ", "=:=:",
        "password" * 2000, "a" * 50_000,
    ],
    "pii": [
        "a@b.c@d.e a@b.c_x@d.e @b.c a@b x@y.z. a..b@c-.d-e.f", "1.2.3.4.5.6.7.8 256.1.1.1 1.2.3.255 0001.02.3.4 1.2.3",
        "4111 1111 1111 1111 4111-1111-1111-1112 4111  1111 41111111111111 4111111111111111 4111111111111111",
        "+1 (234) 567-8901 +12345678 +1234567890123456 ++1234567890 +1 2 3 4 5 6 7 8 9 0 +1+2345678901",
        "é\U0001f600 a@b.co \U0001f600 1.1.1.1", "9" * 30_000, "a." * 20_000 + "b", "a" * 40_000, "1 " * 5000, "x@" + "a." * 9000 + "b",
        "1.1.1.1 " * 1500, "+" * 2000 + "1" * 12, "@", "",
    ],
}


@pytest.mark.parametrize("name", ["secrets", "pii"])
def test_base_spans(spark, name):
    spans_of, base, kinds = {
        "secrets": (secret_spans, secret_base, secrets.KINDS),
        "pii": (pii_spans, pii_base, pii.KINDS),
    }[name]
    rows = awkward() + planted(name) + [(5000 + i, t) for i, t in enumerate(TRICKY[name])]
    got = spans_of(table(spark, rows)).collect()
    ours, want = [], []
    for r in got:
        spans = [(s.start, s.end, s.kind) for s in r.spans]
        assert spans == sorted(spans, key=lambda s: (s[0], [*kinds, "model"].index(s[2])))
        fixed = [s for s in spans if s[2] != "model"]
        for a, b, _ in (s for s in spans if s[2] == "model"):
            assert all(b <= x or y <= a for x, y, _ in fixed)
        ours.append((str(r.doc_id), fixed))
    for i, t in rows:
        want.append((str(i), [(a, b, kinds[k]) for a, k, b in base(t or "")]))
    assert sorted(ours) == sorted(want)


def test_network_finds_secrets_of_other_names_and_spares_numbers(spark):
    rng = random.Random(3)
    hexa = "".join(rng.choices("0123456789abcdef", k=22))  # too short for a fixed pattern
    rows = planted("secrets") + [(1, f'auth = "{hexa}" end'), (2, "room 12345678901234 and part item-number-123")]
    spans = {r.doc_id: [s.kind for s in r.spans] for r in secret_spans(table(spark, rows)).collect()}
    assert spans[1] == ["model"] and spans[2] == []
    plain = [i for i, t in rows if i >= 1000 and not secret_base(t)]
    assert sum(bool(spans[i]) for i in plain) <= 0.05 * len(plain)


def test_windows_reach_every_place_of_a_candidate():
    text = "before " + "p" * 60 + "q" * 61 + " after"
    windows = secrets.windows_of(text, 7, 7 + 121)
    rows = [windows[i : i + secrets.WINDOW] for i in range(0, len(windows), secrets.WINDOW)]
    bodies = [r[secrets.LEFT : secrets.LEFT + secrets.BODY] for r in rows]
    places = {b[i : i + secrets.WIDTH] for b in bodies for i in range(secrets.BODY - secrets.WIDTH + 1)}
    run = text[7 : 7 + 121].encode()
    assert {run[i : i + secrets.WIDTH] for i in range(len(run) - secrets.WIDTH + 1)} <= places
    assert rows[0].startswith(b"\0" * 17 + b"before ") and rows[-1].endswith(b" after\0\0")
    assert not any(r[: secrets.LEFT].strip(b"\0") for r in rows[1:])
    for size in (1, 39, 40, 41, 76, 77):
        assert len(secrets.windows_of("x" * size, 0, size)) == secrets.WINDOW * (1 if size <= 40 else 2 if size <= 76 else 3)


def test_long_candidates_and_those_without_a_digit(spark):
    """A value behind 60 characters of path, and one of letters alone, among words that are none."""
    rng = random.Random(8)
    path = "/" + "/".join("folder" for _ in range(9)) + "/"
    hexa = "".join(rng.choices("0123456789abcdef", k=22))
    letters = "".join(rng.choices("abcdef", k=22))
    findings = [(x["window"], x["label"]) for _, t in planted("secrets") for x in secrets.scan(t)[1]]
    model = secrets.train(findings)

    def score(text):
        windows = [x["window"] for x in secrets.scan(text)[1]]
        return model.probability(secrets._codes(windows), secrets._sizes(windows))

    # What stands at the end of a long run counts as what stands at its begin does.
    assert score(f"see {path}{hexa} end")[0] > score(f"see {path}folder end")[0]
    assert score(f"see {'x' * 60}{hexa} end")[0] > score(f"see {'x' * 82} end")[0]
    # The network, and no test before it, judges runs of letters.
    seen = secrets.scan(f"auth {letters} end internationalization")[1]
    assert [(x["start"], x["digit"], x["label"]) for x in seen] == [(5, False, 0), (32, False, 0)]
    rows = planted("secrets") + [(4, "internationalization straightforwardness")]
    got = {r.doc_id: [s.kind for s in r.spans] for r in secret_spans(table(spark, rows)).collect()}
    assert got[4] == []


def test_training_is_calibrated_and_recalls():
    findings = []
    for _, text in planted("secrets"):
        findings += [(s["window"], s["label"]) for s in secrets.scan(text)[1]]
    model = secrets.train(findings, recall=0.98)
    windows = [w for w, _ in findings]
    p = model.probability(secrets._codes(windows), secrets._sizes(windows))
    good = [x for x, (_, y) in zip(p, findings, strict=True) if y]
    assert sum(x >= model.threshold for x in good) >= 0.95 * len(good)
    assert 0.5 <= model.threshold <= 1
    assert secrets.train([]) is None and secrets.train([f for f in findings if f[1]]) is None


def _findings(spark, rows):
    seen = [(bytearray(x["window"]), x["label"], i * 100 + n) for i, t in rows for n, x in enumerate(secrets.scan(t)[1])]
    found = spark.createDataFrame(seen, "window binary, label int, at long")
    return found.select("window", "label", F.xxhash64("window", "at").alias("o"))


def test_every_finding_trains_or_calibrates(spark, monkeypatch):
    """Over several shares: what tasks are shown and what is calibrated on is the whole table."""
    findings = _findings(spark, planted("secrets")).repartition(3)
    monkeypatch.setattr(secrets, "SHARE", 60)
    shown, calibrated = [], []
    trained, calibrate = secrets._trained, secrets.CharCNN.calibrate

    def see_trained(shares, model, weights, epochs):
        shown.append((shares.count(), shares.select("share").distinct().count(), shares.select("window").distinct().count()))
        return trained(shares, model, weights, epochs)

    def see_calibrate(self, bins, labels, times, recall):
        calibrated.append([int(times[labels == y].sum()) for y in (0, 1)])
        calibrate(self, bins, labels, times, recall)

    monkeypatch.setattr(secrets, "_trained", see_trained)
    monkeypatch.setattr(secrets.CharCNN, "calibrate", see_calibrate)
    model = secrets.learn(findings)
    aside = F.pmod("o", F.lit(4)) == 0
    held = [findings.filter(aside & (F.col("label") == y)).count() for y in (0, 1)]
    rest = findings.filter(~aside)
    whole = (rest.count(), rest.select("window").distinct().count())
    assert calibrated == [held]
    assert len(shown) == 1 + secrets.ROUNDS and shown[0][1] == 1 and shown[0][0] < whole[0]
    assert all((n, windows) == whole and shares > 2 for n, shares, windows in shown[1:])
    values = model.flat()
    again = secrets.learn(findings.repartition(5)).flat()
    assert abs(values - again).max() < 1e-6  # how the rows are dealt changes nothing


def test_shares_follow_the_findings_and_not_the_partitions(spark, monkeypatch):
    """More partitions make neither more shares, with a row for each parameter of each, nor another network."""
    findings = _findings(spark, planted("secrets"))
    monkeypatch.setattr(secrets, "SHARE", 60)
    fits, trained = [], secrets._trained

    def see_trained(shares, *rest):
        fits.append(sorted((r["share"], r["count"]) for r in shares.groupBy("share").count().collect()))
        return trained(shares, *rest)

    monkeypatch.setattr(secrets, "_trained", see_trained)
    values, few = secrets.learn(findings).flat(), [*fits]
    fits.clear()
    kind = type(findings)
    for name in ("repartition", "repartitionByRange"):
        more = lambda self, n, *by, dealt=getattr(kind, name): dealt(self, max(n, 61) if by else n, *by)
        monkeypatch.setattr(kind, name, more)
    again = secrets.learn(findings).flat()
    assert len(few) == 1 + secrets.ROUNDS and 2 < len(few[1]) < 20
    assert fits == few
    assert abs(values - again).max() < 1e-6


def test_the_rarer_label_is_shown_more_often_and_calibration_ends(spark):
    import numpy as np

    rows = planted("secrets")
    few = [r for r in rows if secret_base(r[1])][:8] + [r for r in rows if not secret_base(r[1])]
    model = secrets.learn(_findings(spark, few))
    windows = [x["window"] for _, t in rows for x in secrets.scan(t)[1] if x["label"]]
    assert (model.probability(secrets._codes(windows), secrets._sizes(windows)) >= model.threshold).mean() > 0.5
    bins, labels = np.array([-9, -8, -7, 6, 7, 8.0]) * secrets.GRAIN, np.array([0, 0, 0, 1, 1, 1.0])
    model.calibrate(bins, labels, np.array([50.0, 1, 1, 1, 1, 90]))
    assert 0 < model.scale < 1 and 0.5 <= model.threshold
    assert secrets.learn(_findings(spark, few[:8]).filter("label = 1")) is None


def test_gradients_of_the_network():
    import numpy as np

    rng = np.random.default_rng(0)
    model = secrets.CharCNN(filters=3, dims=2)
    codes = rng.integers(32, 120, (6, secrets.WINDOW)).astype(np.uint8)
    y, w = rng.integers(0, 2, 6).astype(float), np.ones(6)
    loss = lambda: float((w * (np.logaddexp(0, model.logits(codes)) - y * model.logits(codes))).mean())
    grads = model._gradients(codes, y, w)
    for value, grad in zip((model.table, model.kernel, model.bias, model.weight, model.offset), grads, strict=True):
        at = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        value[at] += 1e-5
        up = loss()
        value[at] -= 2e-5
        assert abs((up - loss()) / 2e-5 - grad[at]) < 1e-4
        value[at] += 1e-5


def test_trees_select_what_looks_alike(spark):
    rows = planted("pii") + [(1, "call (555) 010-2345 now +1 (555) 010-2345 now"), (2, "no 123456789 of 2024-01-02 11")]
    got = {r.doc_id: [(s.start, s.kind) for s in r.spans] for r in pii_spans(table(spark, rows)).collect()}
    assert (24, "phone") in got[1]
    assert got[2] == []
    plain = [i for i, t in rows if i >= 1000 and not pii_base(t)]
    assert sum(bool(got[i]) for i in plain) <= 0.05 * len(plain)


@pytest.mark.parametrize("name", ["secrets", "pii"])
def test_redaction_keeps_rows_and_columns(spark, name):
    change, base, mark = {
        "secrets": (redact_secrets, secret_base, "[SECRET]"),
        "pii": (redact_pii, pii_base, "[PII]"),
    }[name]
    rows = awkward() + planted(name)[:150]
    docs = table(spark, rows)
    out = change(docs)
    assert out.dtypes == docs.dtypes
    got = out.collect()
    assert len(got) == len(rows) and {r.row_key for r in got} == {"clash"}
    texts = {}
    for r in got:
        texts.setdefault(r.doc_id, set()).add(r.text)
        assert r.n_chars == (None if r.text is None else len(r.text))
    for i, t in rows:
        if t is not None and base(t):
            clean, at = "", 0
            for a, _, b in base(t):
                clean, at = (clean + t[at:a] + mark if a >= at else clean), max(at, b)
            assert any(mark in x for x in texts[i])
            if not any(x.count(mark) != clean.count(mark) for x in texts[i]):
                assert clean + t[at:] in texts[i]
        elif name == "secrets" or not t:
            assert t in texts[i]


def test_redaction_learns_from_more_findings_than_a_sample(spark, monkeypatch):
    """9,100 findings, over 4,000 of each label."""
    rng = random.Random(5)
    value = lambda: "".join(rng.choices("0123456789abcdef", k=12))
    rows = [(i, " ".join(f"token={value()} item-number-{rng.randint(100, 999)}" for _ in range(91))) for i in range(50)]
    learned = []
    monkeypatch.setattr(secrets, "learn", lambda findings, recall: learned.append(findings.groupBy("label").count().collect()))
    out = redact_secrets(table(spark, rows)).select("text").collect()
    assert [{r["label"]: r["count"] for r in found} for found in learned] == [{0: 4550, 1: 4550}]
    assert sum(r.text.count("[SECRET]") for r in out) == 4550


def test_empty_tables(spark):
    docs = table(spark, awkward()).filter(F.lit(False))
    for f in (secret_spans, pii_spans, redact_secrets, redact_pii):
        assert f(docs).collect() == []


@pytest.mark.parametrize("name", ["op2_secret_scan", "op6_pii"])
def test_queries_over_the_given_table(spark, name):
    sf = "/root/testdata/sf0.001"
    base, kinds = {"op2_secret_scan": (secret_base, secrets.KINDS), "op6_pii": (pii_base, pii.KINDS)}[name]
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.QUERIES[name](spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        found = base(texts[r.doc_id])
        spelled = ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in found)
        assert r.base_sha256 == hashlib.sha256(spelled.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in kinds] == [sum(x[1] == i for x in found) for i in range(len(kinds))]
        assert [s for s in r.spans.split(",") if s and not s.startswith("model")] == [s for s in spelled.split(",") if s]


def test_personal_data_is_found_without_python(spark):
    plan = pii._proposals(F.col("text"))
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(pii._base(F.col("text")), plan)
    assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().toString())


def test_of_overlapping_proposals_each_is_kept_that_no_kept_one_covers(spark):
    """A chain: the best takes the middle one along, and the last stays."""
    from skyledger.llm import pii

    spans = [(0, 10, 0.9), (8, 14, 0.8), (12, 20, 0.7), (30, 34, 0.7), (32, 36, 0.7)]
    rows = spark.createDataFrame([([{"start": a, "end": b, "score": s} for a, b, s in spans],)],
                                 "c array<struct<start: int, end: int, score: double>>")
    scored = F.transform("c", lambda c: F.struct(c["score"].alias("score"), (c["end"] - c["start"]).alias("size"),
                                                 (-c["start"]).alias("early"), c["start"].alias("start"), c["end"].alias("end")))
    (got,) = rows.select(pii.undisputed(scored).alias("k")).first()
    assert sorted((x.start, x.end) for x in got) == [(0, 10), (12, 20), (30, 34)]
