"""Entities are replaced to their end, and in the forms that were missing."""

from __future__ import annotations

import random
import re

from ledgerloom.llm import pii


def replaced(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    rows = sorted(pii.pseudonymize(df, "k").collect())
    return [r.text for r in rows], [r.entity_kinds for r in rows]


def test_a_secret_is_replaced_to_the_end_of_its_characters(spark):
    draw = random.Random(1)
    tokens = ["".join(draw.choices("abcdefghijklmnopqrstuvwxyzABCDEF0123456789", k=n)) for n in (600, 512, 513, 20_000)]
    texts, kinds = replaced(spark, [f"auth_token={t} follows" for t in tokens])
    for token, text, kind in zip(tokens, texts, kinds, strict=True):
        assert kind == ["secret"] and re.fullmatch(rf"auth_token=[A-Za-z0-9]{{{len(token)}}} follows", text)
        made = text[11:11 + len(token)]
        assert not any(token[k:k + 12] in made for k in range(0, len(token) - 12, 4))


def test_a_name_is_replaced_to_its_last_word(spark):
    long = "Wolfeschlegelsteinhausenbergerdorff"
    texts, kinds = replaced(spark, [
        "saw Dr. Juan Carlos García López today", "hört Herr Ludwig van Beethoven zu", "Frau von der Leyen kam", f"Mr Hubert {long} left",
        "Señora María de la Cruz y Vega vino", "Prof. Seán O’Brien spoke", "Herr Beethoven schrieb"])
    assert kinds == [["name"]] * 7
    for word in ["Juan", "Carlos", "García", "López", "Ludwig", "Beethoven", "Leyen", "Hubert", long, long[31:], "María", "Cruz", "Vega", "Seán", "Brien"]:
        assert not any(word in t for t in texts), word
    name = r"\p{Lu}\p{L}+".replace(r"\p{Lu}", "[A-Z]").replace(r"\p{L}", "[A-Za-z-]")  # a surrogate that was drawn again has a hyphen
    for text, shape in zip(texts, ["saw Dr. N N N N today", "hört Herr N van N zu", "Frau von der N kam", "Mr N N left", "Señora N de la N y N vino", "Prof. N N spoke", "Herr N schrieb"], strict=True):
        assert re.fullmatch(re.sub(r"\bN\b", lambda _: name, shape), text), (shape, text)
    # The surname is one entity with and without the words before it.
    assert texts[1].split()[-2] == texts[6].split()[1]


def test_phones_with_spaces_and_addresses_of_eight_groups(spark):
    given = ["(555) 123 4567", "2001:0db8:85a3:0000:0000:8a2e:0370:7334", "2001:db8:85a3::8a2e:370:7334", "fe80::1", "::1", "::ffff:192.0.2.128", "64:ff9b::10.1.2.3", "FE80::AB"]
    texts, kinds = replaced(spark, [f"source:{x}. Then" for x in given] + ["at 12:30:45 std::vector a:b::c++ :: x", "aa:bb:cc:dd:ee:ff", ":".join(["a1"] * 16)])
    assert kinds == [["phone"]] + [["ip"]] * 7 + [kinds[-3], [], []]
    assert re.fullmatch(r"source:\(\d{3}\) \d{3} \d{4}\. Then", texts[0]) and "123 4567" not in texts[0]
    for text in texts[1:8]:
        assert re.fullmatch(r"source:2001:db8(:[0-9a-f]{4}){6}\. Then", text), text
    assert texts[1] == texts[2] and len(set(texts[1:8])) == 6
    assert texts[8].startswith("at 12:30:45 std::vector") and texts[8].endswith(" :: x")
