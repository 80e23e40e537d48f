import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from saltmarsh.functions import parse, presentation, text, titles
from saltmarsh.operators import quality


def column(spark, values, build):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.x for r in df.select("i", build(F.col("v")).alias("x")).orderBy("i").collect()]


def test_three_number_parsers(spark):
    said = ["1,234.50", "Bs 1.234,50", "1,234", "1.234", "-5", "NaN", "1_000", "1e5", "", None, "x 7 y", "$ 3"]
    table = column(spark, said, parse.table_number)
    assert table == [Decimal(x) if x else None for x in ("1.2345", "1234.5", "1.234", "1.234", "-5", None, None, "100000", None, None, None, "3")]
    assert column(spark, ["1.234,50", "Bs 3", " 1 000 "], parse.document_number) == [Decimal("1234.5"), None, Decimal(1000)]
    price = column(spark, ["1,234.50", "1.234,50", "-5", "1.234.567", "n/a", None], parse.price_number)
    assert price == [Decimal("1234.5"), Decimal("1234.5"), Decimal(5), None, None, None]


def test_booleans_and_dates(spark):
    assert column(spark, ["sí", "X", "no", "0", "quizá", " ", None], parse.boolean) == [True, True, False, False, None, None, None]
    got = column(spark, ["2026-1-2", "02/01/2026", "2-1-2026", "02/01/26", "2026-01-02 10:00", "31/02/2026", ""], lambda c: parse.date(c).cast("string"))
    assert got == ["2026-01-02"] * 3 + [None] * 4


@pytest.mark.parametrize(
    "said, value, failed",
    [
        ("color=rojo;talla=M", {"color": "rojo", "talla": "M"}, False),
        ('{"Talla": "M", "Color": "rojo"}', {"talla": "M", "color": "rojo"}, False),
        ("Tamaño : 5 ml | Línea=uno", {"tamano": "5 ml", "linea": "uno"}, False),
        ("color=rojo;color=azul", None, True),
        ('{"Color":"rojo","color":"azul"}', None, True),
        ("5", None, True),
        ("null", None, True),
        ('{"a":{"b":1}}', None, True),
        ("a=", None, True),
        ("solo", None, True),
        ("", None, False),
        (None, None, False),
    ],
)
def test_attributes(spark, said, value, failed):
    (got,) = column(spark, [said], parse.attributes)
    assert (got.value, got.error is not None) == (value, failed)


def test_attribute_parts_lose_spaces_only(spark):
    got = column(spark, ["color=10", "a=1;talla=41", "0=x", " a = 1 ;  ; b=2 ", '{"a": " 0 ", "b": "10"}'], parse.attributes)
    assert [(r.value, r.error) for r in got] == [({"color": "10"}, None), ({"a": "1", "talla": "41"}, None), ({"0": "x"}, None), ({"a": "1", "b": "2"}, None), ({"a": "0", "b": "10"}, None)]


def test_keys_are_folded_once(spark):
    df = spark.createDataFrame([("x",)], "v string").select(text.attribute_key(F.col("v")).alias("k"))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("translate(") == 1
    said = [" Color ", "COLOR uno", "Línea", "Li\u0301nea", "Straße", "_a__b_", "\u2028a", " ", ""]
    assert column(spark, said, text.attribute_key) == ["color", "color_uno", "linea", "linea", "strasse", "a_b", "a", None, None]


def test_json_strings(spark):
    said = ["uno 2", "", 'a"b', "a\\b", "a\nb", "ñ/<&>'", "a\u2028b"]
    assert column(spark, said, text.json_string) == [json.dumps(x, ensure_ascii=False) for x in said]


def test_folding(spark):
    assert column(spark, ["Máscara N° 3 &amp; Straße", "MÃ¡scara", None], text.match_key) == ["mascaran3strasse", "mascara", None]
    assert column(spark, ["  Ácido--Hialurónico  ", "¡¿?!"], text.fold_text) == ["acido hialuronico", ""]
    assert column(spark, [" Tamaño (ml) ", "¡!"], text.attribute_key) == ["tamano_ml", None]
    assert column(spark, ["cafÃ©", "café", "Ã y Â", "niÃ±o â‚¬5"], text.repair_mojibake) == ["café", "café", "Ã y Â", "niño €5"]
    assert column(spark, ["a  b\n c "], text.clean_text) == ["a b c"]


def test_canonical_json(spark):
    df = spark.sql("SELECT map('b', 'x\"y', 'a', 'é') AS m")
    assert df.select(text.canonical_json(F.col("m"))).first()[0] == '{"a": "é", "b": "x\\"y"}'


def test_number_text(spark):
    df = spark.sql("SELECT CAST(v AS DECIMAL(38,10)) AS v FROM VALUES ('500'), ('1.50'), ('0') AS t(v)")
    assert [r[0] for r in df.select(parse.number_text(F.col("v"))).collect()] == ["500", "1.5", "0"]


def test_presentations(spark):
    got = column(spark, ["Crema 250 GRS", "Crema 1,5 kg", "Crema x 3", "Crema", "500ml.", "50 grs.", "12 Unidades"], presentation.signature)
    assert [(g.quantity, g.unit) if g else None for g in got] == [("250", "g"), ("1.5", "kg"), ("3", ""), None, None, None, ("12", "u")]
    assert column(spark, ["KGS", "Frascos", None], presentation.unit) == ["kg", "frascos", ""]
    kept = column(spark, ["Crema 50 Bs facial", "Bs 50 y 20 ml , fin", "a&nbsp;b&amp;c"], presentation.clean_fragment)
    assert kept == ["Crema facial", "Bs 50 y, fin", "a b&c"]
    df = spark.sql("SELECT map('color', 'x', 'Volumen', '50 ml') AS a, map('presentation', '1 l') AS b, map('contenido', '1') AS c")
    assert tuple(df.select(*[presentation.from_attributes(F.col(c)) for c in "abc"]).first()) == ("50 ml", "1 l", None)


def test_entities(spark):
    assert column(spark, ["a &amp; b &lt;c&gt; &eacute; &#233;&#xe9; &amp;lt; & &x; AT&T;", "none"], text.unescape) == ["a & b <c> é éé &lt; & &x; AT&T;", "none"]


def test_titles():
    assert titles.title_text("therapy n°3 acido hialuronico") == "Therapy N°3 Ácido Hialurónico"
    assert titles.title_text("blend AHA's tca 20%") == "Blend AHA's TCA 20%"
    assert titles.title_text("- CREMA|N 12 -acido EXOS+ mcCoy de la-piel") == "Crema N°12 Ácido EXOS+ mcCoy de la-Piel"
    assert titles.title_text("cafÃ© &amp; te") == "Café & Te"
    assert titles.title_text(None) is None and titles.title_text("") == ""


def test_descriptions():
    assert titles.description_text("texto inicial. segundo punto. Activos: vitamina C.") == "Texto inicial. Segundo punto.\n\nActivos: vitamina C."
    assert titles.description_text("VITAMINA E: AyUda a cuidar la piel.") == "Vitamina e: Ayuda a cuidar la piel."
    assert titles.description_text("Texto inicial. OCROJOJO. PRECIOS\n\nODO TIPO DE PIEL.\n\nTodo tipo de piel.") == "Texto inicial.\n\nTodo tipo de piel."
    assert titles.description_text("Guardado guardar en frío") == "Guardado: guardar en frío"
    assert titles.description_text(None) is None


def test_look_alikes_of_defects(spark):
    sound = "El equipo LaserLab trabaja bien. Nada que corregir aquí."
    cases = [(sound, []), (sound + " hidra- tante", ["split_word"]), (sound + " hidra- ξ", []), (sound + " cuiDado", ["mixed_case_word"]), (sound + " La la.", ["repeated_words"]), (sound + " reescribir", []), (sound + " ree", ["ocr_noise_tokens"])]
    got = quality.assess(spark.createDataFrame([(t,) for t, _ in cases], "t string"), "t").collect()
    assert [r.flags for r in got] == [f for _, f in cases]
    assert got[0].status == "pass" and got[1].status == "reconstruct"
