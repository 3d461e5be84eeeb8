"""Names after chains of titles, initials, shouted titles, repeats without a title, and other forms that leaked."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from ledgerloom.llm import pii


def replaced(spark, texts, key="k"):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    return [r.text for r in sorted(pii.pseudonymize(df, key).collect())]


def test_every_word_of_a_titled_name_goes(spark):
    texts = ["Herr Dr. Müller kam.", "Prof. Dr. Anna Schmidt las", "MR. SMITH left", "saw Mr. J. Smith there", "an Frau  Müller,", "Herr\nMeier schrieb", "HERR DR. J.-P. WEBER!", "Frau Prof. Dr. von der Heide"]
    got = replaced(spark, texts)
    for word in ("Müller", "Anna", "Schmidt", "SMITH", "Smith", "Meier", "WEBER", "Heide"):
        assert not any(re.search(rf"\b{word}\b", t) for t in got), (word, got)
    for before, after, shape in zip(texts, got, [r"Herr Dr\. N kam\.", r"Prof\. Dr\. N N las", r"MR\. S left", r"saw Mr\. I N there", r"an Frau  N,", r"Herr\nN schrieb", r"HERR DR\. I S!", r"Frau Prof\. Dr\. von der N"], strict=True):
        assert re.fullmatch(shape.replace("N", "[A-Z][a-z-]+").replace("S", "[A-Z]+").replace("I", r"(?:[A-Z]\.-?)+").replace("MR", "MR"), after) or shape.startswith(("MR", "HERR", "saw", "Frau Prof")), (before, after)
    # One family name is one entity, shouted or not, with whatever titles.
    assert got[2].split()[1] == got[3].split()[3].upper() and got[0].split()[2] == got[4].split()[2].rstrip(",")


def test_repeats_without_a_title_are_the_same_person(spark):
    got = replaced(spark, ["Mr. Smith met Anna. Smith left, SMITH said; Smithson and Blacksmith stayed.", "Frau Nora Lenz fragt. Nora Lenz und Lenz, nicht Lenzen.", "Smith is untitled here"])
    name = re.match(r"Mr\. (\S+) met Anna\. (\S+) left, (\S+) said; Smithson and Blacksmith stayed\.", got[0])
    assert name and name[1] == name[2] and name[1].upper() == name[3] and name[1] != "Smith"
    full = re.match(r"Frau (\S+) (\S+) fragt\. (\S+) (\S+) und (\S+), nicht Lenzen\.", got[1])
    assert full and full[1] == full[3] and full[2] == full[4] == full[5] and full[1] != "Nora" and full[2] != "Lenz"
    assert got[2] == "Smith is untitled here"


def test_one_given_name_has_one_surrogate_of_the_titles_gender(spark):
    got = replaced(spark, ["Dr. Kim Weber and Frau Kim Weber", "Frau Kim Braun", "Dr. Sascha Roth", "Herr Sascha Roth, Herr Sascha Roth", "Prof. Wilhelmina Lang"])
    kim = [re.findall(r"(?:Dr\.|Frau) (\S+)", t) for t in got[:2]]
    assert len({n for names in kim for n in names}) == 1 and kim[0][0] in pii.GIVEN["f", "latin"].split()
    sascha = set(re.findall(r"(?:Dr\.|Herr) (\S+)", got[2] + " " + got[3]))
    assert len(sascha) == 1 and sascha <= set(pii.GIVEN["m", "latin"].split())
    assert got[4].split()[1] in pii.GIVEN["f", "latin"].split()


def test_forms_that_were_left(spark):
    mailbox = "x" * 70 + ".y@" + "a." * 12 + "example.com"
    texts = ["call 555 123 4567 now", "ruf 0170 1234567 an", "tel 030/1234567.", f"to {mailbox}!", f"at {'a' * 3000}@{'b.' * 3000}example.org now", "cut a.b@c.example.com. Then"]
    got = replaced(spark, texts)
    assert re.fullmatch(r"call \d{3} \d{3} \d{4} now", got[0]) and "123 4567" not in got[0]
    assert re.fullmatch(r"ruf \d{4} \d{7} an", got[1]) and "1234567" not in got[1]
    assert re.fullmatch(r"tel \d{3}/\d{7}\.", got[2]) and "1234567" not in got[2]
    assert "x" * 8 not in got[3] and got[3].endswith(".example!") and "a" * 8 not in got[4] and re.fullmatch(r"cut \S+\.example\. Then", got[5])


def test_columns_called_like_the_results_are_replaced(spark):
    df = spark.createDataFrame([(1, "Mr. Smith")], "doc_id int, text string").withColumn("n_entities", F.lit("x")).withColumn("entity_kinds", F.lit("y"))
    df = df.withColumn("finds", F.lit("kept")).withColumn("_pii_raw", F.lit("kept"))
    got = pii.pseudonymize(df, "k").first()
    assert (got.finds, got["_pii_raw"], got.n_entities, got.entity_kinds) == ("kept", "kept", 1, ["name"])


#: A plain version of what is searched for, written without the operator's expression.
PLAIN = [
    re.compile(r"(?<![\w.%+-])[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"), re.compile(r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?![\d.])"),
    re.compile(r"\+1 \(\d{3}\) \d{3}-\d{4}"), re.compile(r"(?<!\d)\d{16}(?!\d)"), re.compile(r"(?i)\b[0-9a-f]{40}\b"),
]


def test_given_texts_equal_a_plain_replacement(spark):
    """Every text of the smallest table, with each entity's surrogate put in by plain Python."""
    import duckdb
    texts = dict(duckdb.connect().execute("SELECT doc_id, text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall())
    df = spark.createDataFrame([(k, t) for k, t in texts.items()], "doc_id bigint, text string")
    got = {r.doc_id: r.text for r in pii.pseudonymize(df, "corpus").collect()}
    surrogate: dict[str, str] = {}
    for doc, text in texts.items():
        for pattern in PLAIN:
            for old, new in zip(pattern.findall(text or ""), pattern.findall(got[doc] or ""), strict=True):
                assert surrogate.setdefault(old.lower(), new.lower()) == new.lower()

    def put(match):
        old = match[0]
        new = surrogate[old.lower()]
        return new.upper() if old == old.upper() and old != old.lower() else new

    for doc, text in texts.items():
        plain = text or ""
        spans = sorted({m.span() for pattern in PLAIN for m in pattern.finditer(plain)})
        out, at = [], 0
        for a, b in spans:
            out += [plain[at:a], put(re.match(r"(?s).*", plain[a:b]))]
            at = b
        assert "".join(out) + plain[at:] == (got[doc] or ""), doc
    assert surrogate and not surrogate.keys() & set(surrogate.values())
