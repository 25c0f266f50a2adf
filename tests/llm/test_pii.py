import random
import re
from datetime import date, timedelta

from pyspark.sql import functions as F

from tidemark.llm.pii import DAYS, FOUND, feistel, luhn, pseudonymise

KEY = "k"


def make(spark, texts):
    df = spark.createDataFrame([(t, i, "x") for i, t in enumerate(texts)], "text string, id int, kinds string")
    return {r.id: r for r in pseudonymise(df, KEY).collect()}


def luhn_sum(d):
    return sum(sum(divmod(2 * int(c), 10)) if k % 2 else int(c) for k, c in enumerate(reversed(d))) % 10


def test_feistel_is_a_permutation(spark):
    for radices in ([7, 11], [5, 3, 4], [50]):
        n = 1
        for r in radices:
            n *= r
        df = spark.range(n)
        place, parts = F.col("id"), []
        for r in radices:
            parts.append((place % r).cast("int"))
            place = F.floor(place / r)
        out = df.select(feistel(F.array(*parts), F.array(*(F.lit(r) for r in radices)), F.lit("t"), KEY).alias("v")).collect()
        got = [tuple(r.v) for r in out]
        assert len(set(got)) == n and all(0 <= x < r for v in got for x, r in zip(v, radices, strict=True))


def test_dates_permute_and_stay_dates(spark):
    days = [date(1900, 1, 1) + timedelta(d) for d in range(0, DAYS, 7)]
    got = make(spark, [f"on {d} or {d:%d.%m.%Y}" for d in days])
    seen = set()
    for i, d in enumerate(days):
        m = re.fullmatch(r"on (\d{4}-\d\d-\d\d) or (\d\d)\.(\d\d)\.(\d{4})", got[i].text)
        new = date.fromisoformat(m[1])
        assert new == date(int(m[4]), int(m[3]), int(m[2])) and 1900 <= new.year <= 2099
        seen.add(new)
    assert len(seen) == len(days)


def test_formats_links_and_validity(spark):
    card = "4785380592391139"
    texts = [
        f"a {card}, b 4785 3805 9239 1139; c 4785-3805-9239-1139.", "not valid 4785380592391138", "ip 233.233.171.252 and 1.2.3.999 v1.2.3.4.5",
        "call +1 (743) 555-3824 or (743) 555-3824", "mail hein.19@mail5.example.com, HEIN@x.co!", 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"###',
        "ssn 123-45-6789 but 000-45-6789 and 666-12-1234", "iban GB82 WEST 1234 5698 7654 32 or GB82WEST12345698765432 not GB83WEST12345698765432", "on 2024-02-30 and 31.12.2020 and 12/31/2020", None, "", "no digits here", "x 1 22 333 4444 end",
    ]
    got = make(spark, texts)
    a, b, c = re.findall(r"[\d -]{16,}\d", got[0].text)
    assert a != card and re.sub(r"\D", "", b) == a.strip() == re.sub(r"\D", "", c) and luhn_sum(a.strip()) == 0 and b.strip()[4] == " " and c.strip()[4] == "-"
    assert got[1].text == texts[1] and got[1].pii_kinds == []
    ip = re.match(r"ip (\d+)\.(\d+)\.(\d+)\.(\d+) and 1\.2\.3\.999 v1\.2\.3\.4\.5$", got[2].text)
    assert all(int(x) < 256 for x in ip.groups()) and "233.233.171.252" not in got[2].text
    assert re.fullmatch(r"call \+1 \(\d{3}\) \d{3}-\d{4} or \(\d{3}\) \d{3}-\d{4}", got[3].text) and len(set(re.findall(r"\(\d.*?-\d{4}", got[3].text))) == 1 and "3824" not in got[3].text
    assert re.fullmatch(r"mail [a-z]{4}\.\d\d@[a-z]{4}\d\.[a-z]{7}\.com, [A-Z]{4}@[a-z]\.co!", got[4].text) and "hein" not in got[4].text
    assert re.fullmatch(r'token = "[0-9a-f]{40}"###', got[5].text) and got[5].text != texts[5] and got[5].pii_kinds == ["hex"]
    assert re.fullmatch(r"ssn \d{3}-\d\d-\d{4} but 000-45-6789 and 666-12-1234", got[6].text) and "123-45" not in got[6].text
    one, two = re.match(r"iban (.{27}) or (.{22}) not GB83WEST12345698765432$", got[7].text).groups()
    number = "".join(str(int(x, 36)) for x in two[4:] + two[:4])
    assert one.replace(" ", "") == two and two[:2] == "GB" and int(number) % 97 == 1 and two != "GB82WEST12345698765432"
    assert got[8].text.startswith("on 2024-02-30 and ") and got[8].pii_kinds == ["date", "date"]
    assert got[9].text is None and got[9].pii_kinds == [] and [got[i].text for i in (10, 11, 12)] == texts[10:]
    assert got[0].kinds == "x"


def test_nothing_but_matches_changes(spark):
    r = random.Random(3)
    texts = ["".join(r.choice(["é", " ", "\n", "a1", "4785380592391139", "🙂", "@", "x@y.org", "-", "1.2.3.4", "2020-01-01"]) for _ in range(60)) for _ in range(50)]
    got = make(spark, texts)
    for i, t in enumerate(texts):
        assert re.split(FOUND, t) == re.split(FOUND, got[i].text)


def test_luhn_and_empty(spark):
    assert spark.range(1).select(luhn(F.array(*(F.lit(int(c)) for c in "79927398713")))).first()[0] == 0
    assert make(spark, []) == {}


def test_numbers_next_to_digits_or_capitals(spark):
    card, iban = "4111111111111111", "DE89370400440532013000"
    other = "GB82WEST12345698765432"
    texts = [
        card, f"card {card} 12/27", "4111 1111 1111 1111 123", f"no 12 {card}", f"{card} 123-45-6789", f"{card}-{card} 7", f"12-{card}-35 and 4111-1111-1111-1111-99",
        iban, f"{iban} BIC", "DE89 3704 0044 0532 0130 00 EUR 500", f"AB12 {iban} A", f"{other} {iban} {card}", "DE89370400440532013001 BIC", "4111111111111112 12/27", "order 1234 4111 1111 1111 1111", "x " * 40_000 + card,
    ]
    got = make(spark, texts)
    new, account = got[0].text, got[7].text
    assert new != card and luhn_sum(new) == 0 and account != iban
    spaced = " ".join(new[k : k + 4] for k in range(0, 16, 4))
    grouped = " ".join(account[k : k + 4] for k in range(0, 22, 4))
    assert got[1].text == f"card {new} 12/27" and got[2].text == f"{spaced} 123" and got[3].text == f"no 12 {new}"
    assert got[4].text.startswith(f"{new} ") and got[4].pii_kinds == ["card", "ssn"] and got[5].text == f"{new}-{new} 7"
    assert got[6].text == f"12-{new}-35 and {spaced.replace(' ', '-')}-99"
    assert got[8].text == f"{account} BIC" and got[9].text == f"{grouped} EUR 500" and got[10].text == f"AB12 {account} A"
    assert re.fullmatch(f"GB.{{20}} {account} {new}", got[11].text) and other not in got[11].text
    shape = lambda t: re.sub("[A-Z]", "A", re.sub("[0-9]", "0", t))
    assert [shape(got[i].text) for i in range(len(texts))] == [shape(t) for t in texts]
    assert [got[i].text for i in (12, 13)] == texts[12:14] and got[12].pii_kinds == got[13].pii_kinds == []
    assert got[14].text == f"order 1234 {spaced}" and got[15].text == "x " * 40_000 + new
