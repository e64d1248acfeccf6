import hashlib
import re

from stintflow.llm import private

from . import cases

# The base patterns as they are given, without the operator's possessive forms.
BASE = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))
ODD = ["mail a@b.c@d.e x a@b.com+x@y.z, 1.2.3.4.5.6.7.8 300.1.1.1 0001.2.3.04 1.2.3.256", "é é@b.com ü@x.de 😀😀 a@😀.com 😀x@y.z",
       "4111 1111 1111 1111 and 4111-1111-1111-1111, 4111  1111 1111 1111 4111111111111111 4111 1111 1111 1112 12345678901234567890",
       "+1 (555) 123-4567 +49 30 1234567. ++1234567890 +12 +1 2", "4111111111111111 +4111111111111111 a4111111111111111@x.y 4111111111111111.1.1.1",
       "1 2 " * 20_000, "1 " * 20_000 + "x", "a.b@c.d " * 2_000, "1." * 30_000, "+1" * 20_000, "-" * 50_000, "4111111111111111-", "1.1.1.1" * 500, "@.@a@b..c a@-.- %@a.b", "٣٣@b.c +1 555 123 4567", None, ""]


def luhn(digits):
    doubled = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def brute(text):
    found = []
    for order, (kind, pattern) in enumerate(BASE):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")),
                    "card": lambda: 14 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 10 <= len(digits) <= 15}[kind]()
            if good:
                found.append((m.start(), order, m.end(), kind))
    said = ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(found))
    return (*(sum(f[3] == kind for f in found) for kind, _ in BASE), hashlib.sha256(said.encode()).hexdigest(), said)


def test_base_spans_against_brute_force(spark):
    given = [(r.doc_id, r.text) for r in spark.read.parquet(f"{cases.SMALL}/documents.parquet").collect()]
    rows = given + [(10_000 + n, t) for n, t in enumerate(ODD + cases.texts())]
    got = {r.doc_id: tuple(r)[1:7] for r in private.report(cases.documents(spark, rows)).collect()}
    assert got == {key: brute(text) for key, text in rows}


def test_checksums_and_context_decide_on_further_kinds(spark):
    text = "IBAN: GB82 WEST 1234 5698 7654 32 and DE89370400440532013000 or DE89370400440532013001 ssn 123-45-6789" + " x" * 30 + " 123-45-6788 z"
    row = private.find(cases.documents(spark, [(1, text)])).first()
    assert [(s.kind, text[s.start:s.end]) for s in row.spans] == [("iban", "GB82 WEST 1234 5698 7654 32"), ("iban", "DE89370400440532013000"), ("ssn", "123-45-6789")]
    assert all(private.ACCEPTED <= s.score <= 1 for s in row.spans)


def test_masked(spark):
    rows = [(1, "write to a@b.com or +1 (555) 123-4567 now"), (2, "4111111111111111 +4111111111111111"), (3, None), (4, "nothing"), (5, "")]
    docs = cases.documents(spark, rows)
    out = private.masked(docs)
    assert out.columns == docs.columns
    assert {r.doc_id: r.text for r in out.collect()} == {1: "write to [EMAIL] or [PHONE] now", 2: "[CARD] +[CARD]", 3: None, 4: "nothing", 5: ""}
    assert private.masked(cases.awkward(spark)).count() == 7 and private.report(cases.awkward(spark)).count() == 7
    assert private.report(cases.empty(spark)).collect() == [] and private.masked(cases.empty(spark)).collect() == []


def test_no_python_in_the_plan(spark):
    docs = spark.read.parquet(f"{cases.SMALL}/documents.parquet")
    for df in (private.report(docs), private.masked(docs)):
        assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())


def spans(spark, text, kind):
    return [text[s.start:s.end] for s in private.find(cases.documents(spark, [(1, text)])).first().spans if s.kind == kind]


def test_account_numbers_before_capitals_codes_and_each_other(spark):
    def account(country, body):
        number = int("".join(str(int(c, 36)) for c in body + country + "00"))
        plain = f"{country}{98 - number % 97:02}{body}"
        return " ".join(plain[k:k + 4] for k in range(0, len(plain), 4))
    spaced = ["ES91 2100 0418 4502 0005 1332", *(account(c, "123456789012345678901234567"[:n - 4]) for n, names in private.IBAN_LENGTHS.items() for c in names.split()[:1])]
    for behind in ("Please", "BIC X", "OK", "I", "ABCD", "GB82 WEST 1234 5698 7654 32", "."):
        text = "; ".join(f"{number} {behind}" for number in spaced)
        assert [x for x in spans(spark, text, "iban") if x in spaced] == spaced
    assert spans(spark, "ref AB12 CDEF 1234 ES91 2100 0418 4502 0005 1332", "iban") == spaced[:1]
    assert spans(spark, "ES91 2100 0418 4502 0005 1333 Please", "iban") == []


def test_context_holds_for_a_list(spark):
    numbers = ["123-45-6789", "223-45-6789", "323-45-6789", "423-45-6789", "523-45-6789", "623-45-6789"]
    listed = ", ".join(numbers[:-1]) + " and " + numbers[-1]
    assert spans(spark, "SSN: " + listed, "ssn") == spans(spark, listed + " are their tax ids; tax id", "ssn") == numbers
    assert spans(spark, f"SSN {numbers[0]} x {numbers[1]} y {numbers[2]} far away from it {numbers[3]}", "ssn") == numbers[:3]
    assert spans(spark, listed, "ssn") == []
    docs = cases.documents(spark, [(1, "SSN: 123-45-6789, 223-45-6789, 323-45-6789")])
    assert private.masked(docs).first().text == "SSN: [SSN], [SSN], [SSN]"


def test_very_many_matches_take_linear_time(spark):
    import time
    took = []
    for count in (1_000, 200_000):
        text = " ".join(f"u{k}@b.com" for k in range(count)) + " ssn 123-45-6789, " + ", ".join(["223-45-6789"] * 1_000)
        docs = cases.documents(spark, [(1, text)])
        start = time.time()
        row = private.report(docs).first()
        took.append(time.time() - start)
        assert row.n_email == count and row.spans.count("ssn:") == 1_001
        masked = private.masked(docs).first().text
        assert masked == " ".join(["[EMAIL]"] * count) + " ssn " + ", ".join(["[SSN]"] * 1_001)
    assert took[1] < 60


def further(text):
    """Spans of the added kinds, found position by position, with their scores."""
    weight = lambda m: sum(int(c) * w for c, w in zip(m, (3, 7, 1) * 3))
    rules = (("iban", 0.6, "iban|account|bank|transfer|konto"), ("routing", 0.2, "routing|aba|rtn"), ("ssn", 0.3, "ssn|social security|tax id"))
    lengths = {c: n for n, cs in private.IBAN_LENGTHS.items() for c in cs.split()}
    out = []
    for kind, base, words in rules:
        found, at = [], 0
        while at < len(text):
            m = None
            if kind == "iban" and not (at and text[at - 1].isalnum()) and text[at:at + 2] in lengths:
                n = lengths[text[at:at + 2]]
                spaced = re.match(r"[A-Z]{2}[0-9]{2}(?: [A-Z0-9]{4})*(?: [A-Z0-9]{1,3})?", text[at:])
                compact = re.match(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{%d}(?![A-Za-z0-9])" % (n - 4), text[at:])
                full = -(-n // 4) - 1 + n
                piece = compact[0] if compact else text[at:at + full] if spaced and not text[at + full:at + full + 1].isalnum() and re.fullmatch(r"[A-Z]{2}[0-9]{2}(?: [A-Z0-9]{4})*(?: [A-Z0-9]{1,3})?", text[at:at + full]) else None
                m = piece
                plain = piece.replace(" ", "") if piece else ""
                good = bool(piece) and len(plain) == n and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1
            elif kind == "routing":
                r = re.compile(r"(?<![0-9A-Za-z.-])[0-9]{9}(?![0-9A-Za-z-]|\.[0-9])").match(text, at)
                m, good = (r[0], weight(r[0]) % 10 == 0) if r else (None, False)
            elif kind == "ssn":
                r = re.compile(r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])").match(text, at)
                m, good = (r[0], r[0][:3] not in ("000", "666") and r[0][0] != "9" and r[0][4:6] != "00" and r[0][7:] != "0000") if r else (None, False)
            if m:
                found.append((at, at + len(m), good))
            at += len(m) if m else 1
        near = lambda s: bool(re.search(rf"\b(?:{words})", s.lower()))
        listed = [k > 0 and len(text[found[k - 1][1]:a]) <= 40 and bool(re.match(private.LISTED, text[found[k - 1][1]:a])) for k, (a, _, _) in enumerate(found)]
        for k, (a, b, good) in enumerate(found):
            said, j = False, k
            while True:
                said |= near(text[max(0, found[j][0] - 40):found[j][0]])
                if not listed[j]:
                    break
                j -= 1
            j = k
            while True:
                said |= near(text[found[j][1]:found[j][1] + 40])
                if j + 1 == len(found) or not listed[j + 1]:
                    break
                j += 1
            score = base + (0.4 if said else 0)
            if good and score >= private.ACCEPTED:
                out.append((a, b, kind, round(score, 2)))
    return sorted(out)


def test_added_kinds_against_brute_force(spark):
    import random
    pick = random.Random(6)
    pieces = ["DE89370400440532013000", "GB82 WEST 1234 5698 7654 32", "NO93 8601 1117 947", "DE89370400440532013001", "021000021", "021000022", "011401533", "123-45-6789", "223-45-6789", "000-12-3456",
              "ssn", "Routing", "account", "and", ",", ";", "filler words in between that are long enough to part them", "é😀", "x", "tax id:", "ABA"]
    rows = [(k, " ".join(pick.choice(pieces) for _ in range(pick.randint(1, 14)))) for k in range(300)]
    kinds = {"iban", "routing", "ssn"}
    got = {r.doc_id: [(s.start, s.end, s.kind, round(s.score, 2)) for s in r.spans if s.kind in kinds] for r in private.find(cases.documents(spark, rows)).collect()}
    assert got == {k: further(text) for k, text in rows}
    assert {kind for found in got.values() for *_, kind, _ in found} == kinds
