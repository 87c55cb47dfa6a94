"""Context words on both sides of a number, whatever other numbers stand between."""

import pytest

from tidegauge.llm import pii

NUMBERS = {"ssn": "123-45-6789", "local_phone": "555-123-4567"}


def test_context_reaches_all_numbers_near_it(docs):
    texts = [
        "call 555-123-4567 or 555-987-6543", "SSN: 123-45-6789, 234-56-7890", "234-56-7890 is my social security number",
        "ssn 000-45-6789 and 123-45-6789", "555-123-4567, 555-123-4568, 555-123-4569: mobile", "call " + "x " * 20 + "555-123-4567",
        "social 123-45-6789 security", "555-123-4567 " + "y " * 20 + "phone", "é" * 30 + " 555-123-4567 😀 tel",
    ]
    table = docs(texts)
    got = [r["spans"] for r in sorted(pii.summary(pii.find(table)).collect())]
    assert got == [
        "local_phone:5:17,local_phone:21:33", "ssn:5:16,ssn:18:29", "ssn:0:11", "ssn:20:31", "local_phone:0:12,local_phone:14:26,local_phone:28:40", "", "", "",
        "local_phone:31:43",
    ]
    clean = [r["text"] for r in sorted(pii.redact(table).collect())]
    assert clean[:4] == ["call [LOCAL_PHONE] or [LOCAL_PHONE]", "SSN: [SSN], [SSN]", "[SSN] is my social security number", "ssn 000-45-6789 and [SSN]"]
    assert clean[5:8] == texts[5:8]


@pytest.mark.parametrize("kind, word", [("ssn", "ssn"), ("local_phone", "fax")])
def test_context_is_the_text_of_the_window(docs, kind, word):
    number = NUMBERS[kind]
    texts = [f"{word} " + ", ".join([number] * n) for n in range(1, 8)] + [", ".join([number] * n) + f" {word}" for n in range(1, 8)]
    table = docs(texts)
    for row in pii.find(table).collect():
        text = texts[row["doc_id"] - 1]
        starts = [i for i in range(len(text)) if text.startswith(number, i)]
        want = [s for s in starts if word in text[max(0, s - 40) : s] or word in text[s + len(number) : s + len(number) + 40]]
        assert [x["start"] for x in row[kind]] == want
