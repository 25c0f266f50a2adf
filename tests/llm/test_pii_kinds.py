"""Every kind against plain Python, and what must hold for all values of a format."""

import hashlib
import random
import re
import time
from datetime import date, timedelta

from tidemark.llm.pii import DAYS, IBAN_LENGTHS, LATE, PATTERNS, ROUNDS, pseudonymise

KEY = "k2"
EPOCH = date(1900, 1, 1)
LATE_DAYS = [d for d in (EPOCH + timedelta(k) for k in range(DAYS)) if d.day > 12]
LENGTH = {c: n for n, names in IBAN_LENGTHS.items() for c in names.split()}


def make(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = {r.id: r for r in pseudonymise(df, KEY).collect()}
    return [got[i] for i in range(len(texts))]


def feistel(values, radices, tweak):
    half = len(values) // 2
    parts, radix = [list(values[:half]), list(values[half:])], [radices[:half], radices[half:]]
    for k in range(ROUNDS):
        own, other = (0, 1) if k % 2 == 0 else (1, 0)
        text = ",".join(map(str, parts[other]))
        parts[own] = [(x + int(hashlib.sha256(f"{KEY}|{tweak}|{k}|{i}|{text}".encode()).hexdigest()[:12], 16)) % radix[own][i] for i, x in enumerate(parts[own])]
    return parts[0] + parts[1]


def refill(shape, filling, wanted):
    filling = iter(filling)
    return "".join(next(filling) if wanted(c) else c for c in shape)


def letters(text, kind):
    codes = [ord(c) for c in text if c.isalnum() and c.isascii()]
    low = [48 if c < 58 else 65 if c < 91 else 97 for c in codes]
    new = feistel([c - b for c, b in zip(codes, low)], [10 if c < 58 else 26 for c in codes], kind + "".join(map(str, low)))
    return refill(text, (chr(x + b) for x, b in zip(new, low)), lambda c: c.isalnum() and c.isascii())


def luhn(d):
    return sum(sum(divmod(2 * int(c), 10)) if k % 2 else int(c) for k, c in enumerate(reversed(d))) % 10


def card(m):
    d = [c for c in m if c.isdigit()]
    front = "".join(map(str, feistel([int(c) for c in d[:-1]], [10] * (len(d) - 1), "card")))
    return refill(m, front + str((10 - luhn(front + "0")) % 10), str.isdigit)


def mod97(text):
    return int("".join(str(int(c, 36)) for c in text)) % 97


def iban(m):
    tight = m.replace(" ", "")
    own = letters(tight[4:], "iban")
    check = 98 - mod97(own + tight[:2] + "00")
    return refill(m, f"{tight[:2]}{check:02d}{own}", str.isalnum)


def email(m):
    top = re.search(r"\.[A-Za-z]+$", m)[0]
    return letters(m[: -len(top)], "email") + top


def hexadecimal(m):
    new = "".join(f"{x:x}" for x in feistel([int(c, 16) for c in m], [16] * len(m), "hex"))
    return new.upper() if re.search("[A-F]", m) else new


def phone(m):
    code = re.match(r"\+[0-9]{1,3}(?=[ .(-])|\+[0-9]|", m)[0]
    d = [int(c) for c in m[len(code) :] if c.isdigit()]
    return code + refill(m[len(code) :], map(str, feistel(d, [10] * len(d), "phone")), str.isdigit)


def ssn(m):
    a, g, s = map(int, m.split("-"))
    if not (1 <= a <= 899 and a != 666 and g and s):
        return m
    a, g, s = feistel([a - 1 - (a > 666), g - 1, s - 1], [898, 99, 9999], "ssn")
    return f"{a + 1 + (a >= 665):03d}-{g + 1:02d}-{s + 1:04d}"


def ip(m):
    v = [int(x) for x in m.split(".")]
    return ".".join(map(str, feistel(v, [256] * 4, "ip"))) if max(v) < 256 else m


def day(m):
    n = [int(x) for x in re.split("[-./]", m)]
    y, mo, d = n if m[4] == "-" else (n[2], n[1], n[0]) if "." in m or n[0] > 12 else (n[2], n[0], n[1])
    try:
        old = date(y, mo, d)
    except ValueError:
        return m
    if not 1900 <= y <= 2099:
        return m
    if d <= 12:
        month, e = feistel([(y - 1900) * 12 + mo - 1, d - 1], [2400, 12], "date to 12")
        new = date(1900 + month // 12, month % 12 + 1, e + 1)
    else:
        rank = LATE_DAYS.index(old)
        while True:
            a, b = feistel([rank // 210, rank % 210], [211, 210], "date from 13")
            rank = a * 210 + b
            if rank < LATE:
                break
        new = LATE_DAYS[rank]
    return f"{new:%Y-%m-%d}" if m[4] == "-" else f"{new:%d.%m.%Y}" if "." in m else f"{new:%d/%m/%Y}" if n[0] > 12 else f"{new:%m/%d/%Y}"


def with_luhn(front):
    return front + str((10 - luhn(front + "0")) % 10)


def with_check(country, own):
    return f"{country}{98 - mod97(own + country + '00'):02d}{own}"


def samples():
    r = random.Random(4)
    digits = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    out = []
    for _ in range(25):
        c = with_luhn(digits(r.randint(12, 18)))
        out += [(card, c), (card, " ".join(re.findall(".{1,4}", c))), (card, "-".join(re.findall(".{1,4}", c)))]
        country = r.choice(sorted(LENGTH))
        own = "".join(r.choice("0123456789ABCXYZ") for _ in range(LENGTH[country] - 4))
        i = with_check(country, own)
        out += [(iban, i), (iban, " ".join(re.findall(".{1,4}", i)))]
        out.append((email, f"{r.choice(['hein', 'A.b_c', 'x+9'])}{digits(2)}@{r.choice(['Mail5.example', 'a-b.c'])}.{r.choice(['com', 'org'])}"))
        out.append((hexadecimal, "".join(r.choice("0123456789abcdef") for _ in range(r.choice([32, 40, 64])))))
        out.append((hexadecimal, "".join(r.choice("0123456789ABCDEF") for _ in range(39)) + "F"))
        out.append((phone, r.choice([f"+1 ({digits(3)}) {digits(3)}-{digits(4)}", f"({digits(3)}) {digits(3)}-{digits(4)}", f"+49 {digits(3)} {digits(4)} {digits(3)}", f"{digits(3)}-{digits(3)}-{digits(4)}"])))
        out.append((ssn, f"{r.choice(['000', '666', '899', '900', digits(3)])}-{digits(2)}-{digits(4)}"))
        out.append((ip, ".".join(str(r.randint(0, 280)) for _ in range(4))))
        d = EPOCH + timedelta(r.randrange(DAYS))
        out += [(day, f"{d:{f}}") for f in ("%Y-%m-%d", "%d.%m.%Y", "%d/%m/%Y", "%m/%d/%Y")] + [(day, f"{r.randint(1890, 2110)}-{r.randint(0, 13):02d}-{r.randint(27, 32)}")]
    out += [(day, x) for x in ("2000-02-29", "1900-02-29", "29/02/2096", "02/29/2096", "31.12.2099", "01.01.1900", "13.01.1900", "31/12/2099")]
    return out


def test_every_kind_against_plain_python(spark):
    cases = samples()
    got = make(spark, [f"see {v}, then" for _, v in cases])
    for (kind, value), r in zip(cases, got, strict=True):
        assert r.text == f"see {kind(value)}, then", (kind.__name__, value)


def test_dates_of_a_format_never_meet(spark):
    days = [EPOCH + timedelta(k) for k in range(DAYS)]
    for formats in (["%Y-%m-%d"], ["%d.%m.%Y"], ["%d/%m/%Y", "%m/%d/%Y"]):
        texts = sorted({f"{d:{f}}" for f in formats for d in days[:: 1 if len(formats) == 1 and formats[0][1] == "Y" else 11]})
        got = [r.text for r in make(spark, texts)]
        assert len(set(got)) == len(texts) and all(re.fullmatch(r"[0-9./-]{10}", x) for x in got)
        if len(texts) == DAYS:
            assert sorted(got) == texts
    linked = make(spark, ["2020-12-31 31.12.2020 31/12/2020 12/31/2020", "2020-04-03 03.04.2020 04/03/2020"])
    for r in linked:
        parts = r.text.split()
        year, month, d = parts[0].split("-")
        assert parts[1] == f"{d}.{month}.{year}" and parts[-1] == f"{month}/{d}/{year}"


def leftmost(text):
    """Cards and IBANs by trying every start and, longest first, every end."""
    out, at = "", 0
    while at < len(text):
        if at == 0 or not (text[at - 1].isascii() and text[at - 1].isalnum()):
            for to in range(min(len(text), at + 80), at, -1):
                v = text[at:to]
                if to < len(text) and (text[to].isascii() and text[to].isalnum()):
                    continue
                tight = v.replace(" ", "")
                if re.fullmatch(r"[0-9]+(?:[ -][0-9]+)*", v) and 13 <= len(d := re.sub("[ -]", "", v)) <= 19 and luhn(d) == 0:
                    out, at = out + card(v), to
                    break
                if re.fullmatch(r"[A-Z]{2}[0-9]{2}[0-9A-Z]*(?: [0-9A-Z]+)*", v) and 15 <= len(tight) <= 34 and LENGTH.get(tight[:2], len(tight)) == len(tight) and mod97(tight[4:] + tight[:4]) == 1:
                    out, at = out + iban(v), to
                    break
            else:
                out, at = out + text[at], at + 1
        else:
            out, at = out + text[at], at + 1
    return out


def test_stretches_against_every_start_and_end(spark):
    r = random.Random(12)
    parts = ["4111111111111111", "4111 1111 1111 1111", "378282246310005", "DE89370400440532013000", "GB82 WEST 1234 5698 7654 32", "QQ" , "EUR 500", "12 27", "7", "0", "1234", "A", "b", "é", "x4111111111111111", "4111111111111111x", "AB12", "ZZ16 0000 1234 5678 901"]
    texts = ["".join(r.choice(parts) + r.choice([" ", " ", " ", "-", "  ", ", ", "\n"]) for _ in range(r.randint(1, 14))) for _ in range(300)]
    got = make(spark, texts)
    for t, x in zip(texts, got, strict=True):
        assert x.text == leftmost(t) and bool(x.pii_kinds) == (x.text != t)


def whole(text):
    """A text's kinds with a shape of their own, by their patterns one after the other, then its cards and IBANs."""
    order = {"email": email, "hex": hexadecimal, "date": day, "ip": ip, "ssn": ssn, "phone": phone}
    shapes, kept = re.compile("|".join(f"(?P<{k}>{PATTERNS[k]})" for k in order)), []

    def shaped(m):
        new = order[m.lastgroup](m[0])
        if new == m[0]:
            return m[0]
        kept.append(new)
        return "\uffff"

    parts = leftmost(shapes.sub(shaped, text)).split("\uffff")
    return "".join(a + b for a, b in zip(parts, [*kept, ""], strict=True))


def test_documents_against_plain_python(spark, monkeypatch):
    import tidemark.llm.queries as m

    monkeypatch.setattr(m, "PII_KEY", KEY)
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    got = {r.doc_id: r.text for r in m.op8_pseudonyms(spark, "/root/testdata/sf0.001").collect()}
    assert got == {i: whole(t) for i, t in texts.items()} and sum(got[i] != t for i, t in texts.items()) > 3


def test_own_marks_in_a_text_stay(spark):
    odd = "".join(chr(0xFDD0 + k) for k in range(12))
    texts = [f"{odd} 4111111111111111 {odd}2020-01-13{odd}", f"{odd}!#$&'()*,;{odd}", f"x{chr(0xFDD9)}!4111111111111111"]
    plain = make(spark, ["4111111111111111", "2020-01-13"])
    got = make(spark, texts)
    assert got[0].text == f"{odd} {plain[0].text} {odd}{plain[1].text}{odd}" and got[0].pii_kinds == ["card", "date"]
    assert got[1].text == texts[1] and got[1].pii_kinds == []
    assert got[2].text == f"x{chr(0xFDD9)}!{plain[0].text}"


def test_long_stretches_take_linear_time(spark):
    r = random.Random(2)
    line = " ".join(with_luhn("".join(r.choice("0123456789") for _ in range(15))) for _ in range(20_000))
    capitals = "ALL CAPITAL TEXT 12 " * 20_000
    began = time.time()
    got = make(spark, [line, capitals, "1 " * 200_000])
    assert len(got[0].pii_kinds) == 20_000 and len(got[0].text) == len(line) and got[1].text == capitals
    assert time.time() - began < 120
