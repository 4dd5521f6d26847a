import hashlib
import random
import re

from threatlens.llm import pii_boosting as pb
from threatlens.llm import queries

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits(m):
    return [int(c) for c in m.group() if c in "0123456789"]


def luhn(d):
    total = 0
    for i, x in enumerate(reversed(d)):
        x = x * 2 if i % 2 else x
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def base(text):
    made = [(0, *m.span()) for m in EMAIL.finditer(text)]
    made += [(1, *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    made += [(2, *m.span()) for m in CARD.finditer(text) if 16 <= len(digits(m)) <= 19 and luhn(digits(m))]
    made += [(3, *m.span()) for m in PHONE.finditer(text) if 8 <= len(digits(m)) <= 15]
    return made


def test_base_spans_as_regular_expressions():
    rng = random.Random(1)
    parts = ["a.b", "@", "x-y", ".", "com", "12", "255", "256", "1.2.3.4", "4111 1111 1111 1111", "-", " ", "+", "(212)", "555", "0",
             "4012888888881881", "é", "٣", "999", "+1 ", "%", "\n", "01", "4242-4242-4242-4242"]
    for _ in range(4000):
        text = "".join(rng.choices(parts, k=rng.randrange(1, 16)))
        assert pb.base_spans(text) == base(text), text
    for text in ("a" * 50_000, "1" * 50_000, "1." * 20_000, "@" * 20_000, "+" * 20_000, "a@" * 20_000, "1 " * 20_000):
        pb.candidates(text, pb.base_spans(text))


def test_all_documents(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.op8_pii(spark, sf_dir).collect()
    assert len(rows) == len(docs)
    found = 0
    for r in rows:
        spans = base(docs[r.doc_id] or "")
        found += len(spans)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for k, *_ in spans) for i in range(4)]
        text = [f"{pb.KINDS[k]}:{s}:{e}" for k, s, e in spans]
        assert r.base_sha256 == hashlib.sha256(",".join(text).encode()).hexdigest()
        assert set(text) <= set(r.spans.split(",")) | ({""} if not text else set())
    assert found


def test_boosting_adds_what_looks_like_the_base(spark):
    rng = random.Random(3)
    rows = []
    for i in range(700):
        phone = f"+1 (2{rng.randrange(10, 99)}) 555-{rng.randrange(1000, 9999)}"
        rows.append((i, f"call {phone} today" if i % 2 else f"pages {rng.randrange(10, 99)}-{rng.randrange(100, 999)} of it"))
    rows.append((9000, "call 1 (212) 555-0100 today"))
    made = pb.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id", "text"]).collect()
    for r in made:
        spans = sorted((s.start, s.end) for s in [*r.base, *r.added])
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:], strict=False))
        if r.text.startswith("pages"):
            assert not r.base and not r.added
        elif r.doc_id < 9000:
            assert len(r.base) == 1
        else:
            assert [r.text[s.start : s.end] for s in r.added] == ["1 (212) 555-0100"]


def test_disguised_spans_are_added_and_clean_texts_left_alone(spark, sf_dir):
    rng = random.Random(6)

    def card():
        head = [rng.randrange(10) for _ in range(15)]
        return "".join(map(str, [*head, next(d for d in range(10) if luhn([*head, d]))]))

    def phone():
        return f"+{rng.randrange(1, 99)} {rng.randrange(100, 999)} {rng.randrange(100, 999)} {rng.randrange(1000, 9999)}"

    words = "the river and a house near some old trees where they went to read about it".split()
    prose = lambda: " ".join(rng.choices(words, k=8))
    plain, hidden, clean = [], [], []
    for _ in range(400):
        number, user = card(), f"{rng.choice(words)}.{rng.choice(words)}@{rng.choice(words)}.org"
        plain += [f"{prose()} mail {user} {prose()}", f"{prose()} card {number} {prose()}", f"{prose()} call {phone()} {prose()}"]
        clean.append(f"{prose()} in {rng.randrange(1900, 2024)}-{rng.randrange(10, 13)}-{rng.randrange(10, 29)} version {rng.randrange(9)}.{rng.randrange(9)}.{rng.randrange(99)}, at {rng.randrange(10, 24)}:{rng.randrange(10, 60)}:{rng.randrange(10, 60)} {prose()}")
    for _ in range(100):
        number, user = card(), f"{rng.choice(words)}.{rng.choice(words)} [at] {rng.choice(words)} [dot] org"
        hidden += [(f"{prose()} mail ", user), (f"{prose()} card ", ".".join(number[i : i + 4] for i in range(0, 16, 4))), (f"{prose()} call ", "00" + phone()[1:])]
    texts = [*plain, *clean, *(f"{a}{b} {prose()}" for a, b in hidden)]
    frame = spark.createDataFrame(list(enumerate(texts)), "n long, text string")
    made = {r.n: r for r in pb.find_personal_data(frame, ["n"]).collect()}
    spurious = [made[n] for n in range(len(plain), len(plain) + len(clean)) if made[n].added]
    assert len(spurious) <= 0.02 * len(clean)
    first = len(plain) + len(clean)
    found = sum(any(s.start < len(a) + len(b) and s.end > len(a) for s in made[first + i].added) for i, (a, b) in enumerate(hidden))
    assert found >= 0.8 * len(hidden)


def test_odd_rows(odd_documents, no_documents):
    made = pb.find_personal_data(odd_documents, ["doc_id", "text"]).collect()
    assert len(made) == odd_documents.count()
    assert all(not r.added for r in made)
    assert pb.find_personal_data(no_documents, ["doc_id"]).collect() == []


def test_a_rare_kind_keeps_its_threshold_beside_a_frequent_one(spark, monkeypatch):
    rng = random.Random(4)
    rows = ["same mail again a.b@c.org and pages 12-345 of it"] * 20_000
    calls = [f"{rng.choice(['call', 'or', 'x'])} +1 (2{rng.randrange(10, 99)}) 555-{rng.randrange(1000, 9999)} today" for _ in range(60)]
    calls += [f"pages {rng.randrange(10, 99)}-{rng.randrange(100, 999)}" for _ in range(60)]
    calibrated, seen = pb._calibrated, []
    monkeypatch.setattr(pb, "_calibrated", lambda *a: seen.append(calibrated(*a)) or seen[-1])
    for texts in (calls, rows + calls):
        pb.find_personal_data(spark.createDataFrame([(t,) for t in texts], "text string"), ["text"], sample=400)
    assert all(3 in limits for limits in seen) and len(seen) == 2
