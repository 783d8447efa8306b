from __future__ import annotations

import re

from shapes import documents, hard_rows

from ridelake.llm import surrogates


def changed(spark, texts, **options):
    df = documents(spark, [(i, t, "en", "a") for i, t in enumerate(texts)])
    rows = surrogates.pseudonymise(df, **options).orderBy("doc_id").collect()
    return [r.text for r in rows], [r.n_entities for r in rows]


def luhn(digits):
    doubled = [int(c) * (2 if i % 2 else 1) for i, c in enumerate(reversed(digits))]
    return sum(x - 9 if x > 9 else x for x in doubled) % 10 == 0


def test_kinds_keep_their_form(spark):
    texts = [
        "Mail Ann.Lee@Corp7.example.com, ann.lee@corp7.example.com!",
        "Call +1 (017) 555-7713 or +1 017 555 7713.",
        "Host 10.2.33.4; again 10.2.33.4",
        "Card 4111 1111 1111 1111 is 4111111111111111, 1234567812345678 is none",
        'token = "f3ef4d6b2755a36d7d9c25bd72c4d5f67e061fda" SSN 123-45-6789',
        "Mr. John Smith met Mrs. Anna Smith; г-жа Иванова",
        "DE89 3704 0044 0532 0130 00",
    ]
    new, counts = changed(spark, texts)
    assert counts == [2, 2, 2, 3, 2, 3, 1]
    a, b = re.findall(r"\S+@\S+\.com", new[0])
    assert a.lower() == b and a[0].isupper() and b != "ann.lee@corp7.example.com"
    phones = re.findall(r"\+1 \(?(\d{3})\)? (\d{3})[- ](\d{4})", new[1])
    assert phones[0] == phones[1] and "555-7713" not in new[1]
    first, second = re.findall(r"\d+(?:\.\d+){3}", new[2])
    assert first == second != "10.2.33.4" and all(0 < int(x) < 256 for x in first.split("."))
    spaced, plain, other = re.findall(r"\d{16}|\d{4} \d{4} \d{4} \d{4}", new[3])
    assert spaced.replace(" ", "") == plain and plain[0] == "4" and luhn(plain) and other[0] == "1"
    assert re.fullmatch(r'token = "[0-9a-f]{40}" SSN \d{3}-\d{2}-\d{4}', new[4])
    mr, mrs, ms = re.fullmatch(r"Mr\. (\w+ \w+) met Mrs\. (\w+ \w+); г-жа (\w+)", new[5]).groups()
    assert mr.split()[0].endswith("o") and mrs.split()[0].endswith("a") and mr.split()[1] == mrs.split()[1]
    assert re.fullmatch("[А-Я][а-я]+а", ms) and ms != "Иванова"
    assert re.fullmatch(r"DE\d\d(?: \d{4}){4} \d\d", new[6])


def test_distinct_entities_stay_distinct(spark):
    # Two-letter names have so few surrogates that attempts collide.
    names = [f"Mr. {a}{b} {c}o" for a in "BCDFG" for b in "aeiou" for c in "KLM"]
    new, _ = changed(spark, names)
    before, after = [t.split()[1:] for t in names], [t.split()[1:] for t in new]
    for place in (0, 1):
        pairs = {(x[place].lower(), y[place].lower()) for x, y in zip(before, after)}
        assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})
        assert not {a for a, _ in pairs} & {b for _, b in pairs}


def test_many_addresses(spark):
    texts = [f"10.0.{i // 250}.{i % 250 + 1}" for i in range(1500)]
    new, _ = changed(spark, texts)
    assert len(set(new)) == 1500 and not set(new) & set(texts)


def test_clean_texts_stay(spark):
    clean = ["In 1990 2000 people paid 12.50 on 2020-01-02.", "v1.2.3", "a@b", "Sir", "x" * 100_000, "Mr lower case", "", None, "1 2 3 4 5 6 7"]
    new, counts = changed(spark, clean)
    assert new == clean and set(counts) == {0}


def test_key_decides(spark):
    one, _ = changed(spark, ["10.2.33.4"], key="a")
    assert one == changed(spark, ["10.2.33.4"], key="a")[0] != changed(spark, ["10.2.33.4"], key="b")[0]


def test_hard_rows(spark):
    df = documents(spark, hard_rows())
    out = surrogates.pseudonymise(df)
    assert out.columns == [*df.columns, "n_entities"] and out.count() == df.count()
    assert surrogates.pseudonymise(documents(spark, [])).count() == 0


def test_everything_about_the_plan_is_native(spark):
    plan = surrogates.pseudonymise(documents(spark, hard_rows()))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
