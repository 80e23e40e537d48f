import json
import random

import pytest
from pyspark.sql import functions as F

from saltmarsh.operators import align, blocks, cards, categories, flows, mapping, prices, quality, skus
from saltmarsh.operators.validation import validate


def codes(df):
    return {r.row_number: [i.code for i in r.issues] for r in df.collect()}


def test_negative_and_duplicate_are_both_invalid(spark):
    rows = spark.createDataFrame([(2, "SKU-1", "a", "-1"), (3, "SKU-1", "b", "2"), (4, None, "c", None), (5, " ", "d", None)], "row_number int, sku string, nombre string, stock string").withColumn("stock", F.col("stock").cast("decimal(38,10)"))
    got = validate(rows, "productos")
    assert codes(got.rows) == {2: ["negative_value"], 3: ["duplicate_in_batch"], 4: [], 5: []}
    assert got.report().first().asDict() == {"total_rows": 4, "valid_rows": 2, "invalid_rows": 2, "blocking_errors": 2, "warnings": 0, "approved_for_publish": False}
    assert validate(rows.limit(0), "productos").report().first().approved_for_publish is False


def test_variant_identity_ignores_key_order(spark):
    rows = spark.createDataFrame([(2, "P", {"color": "rojo", "talla": "M"}), (3, "P", {"talla": "M", "color": "rojo"}), (4, "", {"a": "b"}), (5, "P", None)], "row_number int, sku_producto string, atributos map<string,string>")
    got = codes(validate(rows, "variantes").rows)
    assert got == {2: [], 3: ["duplicate_in_batch"], 4: ["required_field_missing"], 5: ["required_field_missing", "invalid_attributes"]}


def test_mapping(spark):
    assert mapping.suggest(["Código", "Nombre del producto", "Existencias"], "productos") == {"Código": "sku", "Nombre del producto": "nombre", "Existencias": "stock"}
    df = spark.createDataFrame([(2, "PR-1", "Crema", "89,90", "sí"), (3, None, "Crema", "no-es-numero", "x"), (4, " ", None, "", None)], "row_number int, c string, n string, p string, a string")
    df = mapping.drop_blank(df, ["c", "n", "p", "a"])
    got = {r.row_number: r for r in mapping.apply(df, {"c": "sku", "n": "nombre", "p": "precio", "a": "activo"}, "productos", {"tipo": "simple"}).collect()}
    assert str(got[2].precio) == "89.9000000000" and got[2].activo is True and got[2].tipo == "simple" and not got[2].coercion
    assert [e.code for e in got[3].coercion] == ["invalid_type"] and 4 not in got
    for wrong in ({"c": "nada"}, {"z": "sku"}, {"c": "sku", "n": "sku"}):
        with pytest.raises(ValueError):
            mapping.check(wrong, ["c", "n"], "productos")


def test_targets_are_never_guessed(spark):
    items = spark.createDataFrame([("a", "k1", "B1"), ("b", "k2", "B1"), ("c", "k2", "B2"), ("d", "k3", "B1"), ("e", "k3", "B1")], "sku string, name_key string, brand string")
    rows = spark.createDataFrame([(1, "k1", "B9"), (2, "k2", "B2"), (3, "k3", "B1"), (4, "zz", "B1"), (5, None, None)], "price_id int, target_key string, brand string")
    got = {r.price_id: (r.target, r.reason) for r in prices.unique_target(rows, items).collect()}
    assert got == {1: ("a", None), 2: ("c", None), 3: (None, prices.NOT_UNIQUE), 4: (None, prices.NO_RECORD), 5: (None, prices.NO_RECORD)}


def test_presentations_of_one_parent(spark):
    v = spark.createDataFrame([("P", "v1", "250 g"), ("P", "v2", "500 grs"), ("Q", "v3", "1 l")], "sku_producto string, sku_variante string, presentation string")
    rows = spark.createDataFrame([(1, "P", "Crema 500", 5.0), (2, "P", "Crema", 5.0), (3, "P", "Crema 9 g", 5.0), (4, "Q", "Crema", 5.0), (5, "R", "Crema", 5.0)], "price_id int, target string, raw_name string, price double")
    got = {r.price_id: (r.sku_variante, r.reason) for r in prices.match_presentations(rows, v).collect()}
    assert got == {1: ("v2", None), 2: (None, prices.AMBIGUOUS), 3: (None, prices.NOT_FOUND), 4: ("v3", None), 5: (None, prices.RETAINED)}


def test_references(spark):
    refs = spark.createDataFrame([("crema", "c1"), ("cremafacial", "c2"), ("gel", "c3"), ("facial", "c2")], "ref_key string, category string")
    items = spark.createDataFrame([("crema",), ("cremafacialdia",), ("gelx",), ("nada",)], "name_key string")
    got = {r.name_key: r.category for r in categories.by_reference(items, refs).collect()}
    assert got == {"crema": "c1", "cremafacialdia": None, "gelx": "c3", "nada": None}


def test_allocation_fills_gaps(spark):
    need = spark.createDataFrame([("LIB", i) for i in range(6)] + [("ZOE", i) for i in range(3)], "prefix string, _pos int")
    used = spark.createDataFrame([("LIB", 1), ("LIB", 3), ("ZOE", 2)], "prefix string, number int")
    got = {(r.prefix, r._pos): r.number for r in skus.allocate(need, used, "prefix", "_pos").collect()}
    assert [got["LIB", i] for i in range(6)] == [2, 4, 5, 6, 7, 8] and [got["ZOE", i] for i in range(3)] == [1, 3, 4]


def test_assigning_twice_changes_nothing(spark):
    p = spark.createDataFrame([("x", "LIB", 1, None), ("y", "LIB", 2, None)], "identity_key string, prefix string, _pos int, sku string")
    empty = spark.createDataFrame([], "identity_key string, sku string")
    done, state = skus.assign(p, empty)
    first = {r.identity_key: r.sku for r in done.collect()}
    again = {r.identity_key: r.sku for r in skus.assign(p, state)[0].collect()}
    assert first == again == {"x": "LIB-0001", "y": "LIB-0002"}
    wrong = p.withColumn("sku", F.lit("LIB-0009"))
    assert {r.conflict for r in skus.assign(wrong, state)[0].collect()} == {"sku_contradicts_state"}


def test_alignment(spark):
    a = spark.createDataFrame([("k", 1), ("k", 2), ("z", 3)], "key string, l int")
    b = spark.createDataFrame([("k", 10), ("k", 20), ("k", 30)], "key string, r int")
    both, rest = align.bag_align(a, b, ["key"], ["l"], ["r"])
    assert sorted((r.l, r.r) for r in both.collect()) == [(1, 10), (2, 20)]
    assert sorted((r.key, r.side) for r in rest.collect()) == [("k", "right"), ("z", "left")]
    with pytest.raises(ValueError):
        align.by_position(a, b.limit(1), "key")
    rows = spark.createDataFrame([("B", 1), ("a", 1), ("a", 2)], "path string, row int")
    assert sorted((r.row_number, r.path) for r in align.rebased(rows, "path", "row").collect()) == [(2, "a"), (3, "a"), (4, "B")]


def test_ocr_shapes(spark):
    new = '{"res":{"rec_texts":["a","b"],"rec_scores":[96,0.5],"dt_polys":[[[1,2],[5,2],[5,9],[1,9]],[[0,0],[1,0],[1,1],[0,1]]]}}'
    old = '[[[[[1,2],[5,2],[5,9],[1,9]],["a",0.9]]]]'
    df = spark.createDataFrame([(new, old)], "n string, o string")
    got = df.select(blocks.ocr_json_items(F.col("n")).alias("n"), blocks.ocr_legacy_items(F.col("o")).alias("o"), blocks.parse_box(F.lit("1 2 3 4.5")).alias("b"), blocks.parse_box(F.lit("1 2")).alias("z")).first()
    assert [(i.text, i.score, i.box) for i in got.n] == [("a", 0.96, [1, 2, 5, 9]), ("b", 0.5, [0, 0, 1, 1])]
    assert [(i.text, i.score, i.box) for i in got.o] == [("a", 0.9, [1, 2, 5, 9])]
    assert got.b == [1, 2, 3, 4.5] and got.z is None


def test_quality(spark):
    said = ["Texto legible. FREE FREE ocrojojo", "", "Un texto bastante largo que termina bien y dice algo de la crema.", "una una palabra repetida en un texto que es bastante largo.", None, "texto con MÃ¡s problemas de lectura en toda la frase entera."]
    df = quality.assess(spark.createDataFrame([(i, s) for i, s in enumerate(said)], "i int, text string"), "text").orderBy("i")
    got = [(r.flags, r.status, r.score) for r in df.collect()]
    assert got[0][0] == ["too_short", "ocr_noise_tokens", "repeated_words"] and got[0][1] == "reconstruct" and got[0][2] == 46
    assert got[1] == (["empty"], "quarantine", 82) and got[2] == ([], "pass", 100) and got[3][0] == ["repeated_words"]
    assert got[4][1] == "quarantine" and "mojibake" in got[5][0]


def _line(block_id, text, box, confidence=1.0):
    return [cards.Line(x, block_id, box, confidence) for x in text.split("\n")]


def _cards(*blocks_, **options):
    found = cards.split_cards([x for b in blocks_ for x in _line(*b)], **options)
    return [cards.read_card(c, i + 1) for i, c in enumerate(found)]


def test_two_cards():
    a, b = _cards(
        ("b1", "Código: PR-001", (10, 10, 300, 25)),
        ("b2", "Crema hidratante", (10, 30, 300, 45)),
        ("b3", "Precio: Bs 89,90", (10, 50, 300, 65)),
        ("b4", "variante: color=rojo;talla=M", (10, 70, 300, 85)),
        ("b5", "Código: PR-002", (10, 160, 300, 175)),
        ("b6", "Protector solar", (10, 180, 300, 195)),
        ("b7", "Precio: 125.50", (10, 200, 300, 215)),
    )
    assert (a["sku"], a["kind"], a["price"], a["block_ids"]) == ("PR-001", "variable", "89.9", ["b1", "b2", "b3", "b4"])
    assert [v["attributes"] for v in a["variants"]] == [{"color": "rojo", "talla": "M"}]
    assert (b["sku"], b["kind"], b["price"]) == ("PR-002", "simple", "125.5")


def test_a_sheet_with_sizes():
    (c,) = _cards(
        ("b1", "Hidratación inteligente y profunda.", (10, 10, 300, 20), 0.95),
        ("b2", "Máscara\nHidratante", (10, 30, 300, 70), 0.95),
        ("b3", "Presentaciones: 250grs y 500grs", (10, 80, 300, 95), 0.95),
    )
    assert c["name"] == "Máscara Hidratante" and c["kind"] == "variable"
    assert [v["attributes"] for v in c["variants"]] == [{"presentacion": "250grs"}, {"presentacion": "500grs"}]


def test_name_and_description_apart():
    (c,) = _cards(
        ("b1", "MÁSCARA DE LIMÓN", (10, 10, 400, 40)),
        ("b2", "Descripción", (10, 60, 300, 75)),
        ("b3", "Mascarilla facial que hidrata y mejora la luminosidad.", (10, 80, 500, 100)),
        ("b4", "Presentaciones: 50 ml y 100 ml", (10, 120, 350, 135)),
        ("b5", "Modo de uso: Aplicar sobre la piel limpia.", (10, 150, 400, 165)),
    )
    assert (c["name"], c["description"]) == ("Máscara de Limón", "Mascarilla facial que hidrata y mejora la luminosidad.")
    assert json.loads(c["name_evidence"])["block_ids"] == ["b1"] and json.loads(c["description_evidence"])["block_ids"] == ["b3"]


def test_parallel_columns():
    (c,) = _cards(
        ("title", "Aceite de Limpieza", (100, 10, 450, 40)),
        ("left1", "Nuestro aceite limpia, suaviza y protege la piel.", (70, 90, 500, 112)),
        ("left2", "¿Por qué elegirlo?", (70, 140, 400, 162)),
        ("left3", "Contiene aceites cuidadosamente seleccionados.", (70, 170, 500, 192)),
        ("right1", "¿Cómo se utiliza?", (560, 95, 900, 117)),
        ("right2", "Aplica la cantidad necesaria sobre el rostro seco.", (560, 130, 980, 152)),
        ("right3", "Retira con abundante agua templada.", (560, 165, 900, 187)),
        ("badge", "FRAGANCE FREE", (70, 220, 300, 238)),
        gap=90.0,
    )
    text = c["description"]
    assert text.index("Nuestro") < text.index("¿Cómo") and "FRAGANCE" not in text and "\n\n" in text


def test_callouts_below():
    found = _cards(
        ("title", "Máscara Iluminadora", (320, 110, 520, 180)),
        ("body", "Descripción principal legible.", (75, 330, 300, 345)),
        ("w", "ADVERTENCIAS:", (75, 700, 150, 715)),
        ("wt", "Uso externo.", (75, 725, 150, 740)),
        ("s", "SENSIBILIDAD:", (210, 700, 300, 715)),
        ("st", "Suspender si irrita.", (210, 725, 320, 740)),
        ("p", "PROTECCIÓN SOLAR:", (345, 700, 450, 715)),
        ("pt", "Usar protector.", (345, 725, 460, 740)),
        ("g", "GUARDADO:", (480, 700, 550, 715)),
        ("gt", "Lugar fresco.", (480, 725, 570, 740)),
    )
    assert len(found) == 1
    text = found[0]["description"]
    at = [text.index(x) for x in ("Uso externo", "Suspender", "Usar protector", "Lugar fresco")]
    assert at == sorted(at) and "Usar protector Suspender" not in text


def test_titles_go_on_from_the_line_above():
    lines = [x for b in (("a", "BOOSTER", (10, 10, 200, 40)), ("b", "VITAMINA FORTE", (10, 50, 300, 80)), ("c", "texto corrido, nada más", (10, 200, 300, 212))) for x in _line(*b)]
    assert cards._goes_on(lines, 1) and not cards._goes_on(lines, 2)
    assert cards.name_text("serum n°3 ADN de la-piel") == "Serum N°3 ADN de la-Piel"
    assert cards.select_name([]) == (None, -1, -1)


def test_cards_of_pages(spark):
    rows = [("f", 1, 1000.0, "b0", "Código: A-123", [0.0, 0.0, 50.0, 20.0], 0.4), ("f", 1, 1000.0, "b1", "Crema\nAzul", [0.0, 25.0, 50.0, 60.0], 0.4), ("f", 1, 1000.0, "b2", "Precio: 9", [0.0, 65.0, 50.0, 80.0], None), ("g", 1, None, "b0", " ", None, None)]
    blocks_ = spark.createDataFrame(rows, "source_file string, page_number int, width double, block_id string, text string, bbox array<double>, confidence double")
    lines = cards.lines_of(blocks_)
    found = cards.with_issues(cards.cards(lines))
    (c,) = found.collect()
    assert (c.sku, c.name, c.price, c.block_ids, c.issues) == ("A-123", "Crema Azul", "9", ["b0", "b1", "b2"], ["low_confidence"])
    assert cards.cards(lines.limit(0)).count() == 0
    assert [r.source_file for r in cards.nothing_found(blocks_, found).collect()] == ["g"]


def test_orders(spark):
    v = spark.createDataFrame([("B", "2", None), ("A", None, {"k": "2"}), ("A", None, {"k": "1"}), (None, "9", None)], "sku_producto string, sku_variante string, atributos map<string,string>")
    assert [(r.sku_producto, r.atributos) for r in flows.order_variants(v).collect()] == [(None, None), ("A", {"k": "1"}), ("A", {"k": "2"}), ("B", None)]
    products = spark.createDataFrame([(2, "rouse", "Zeta", "d"), (3, "Libra", "beta", None), (4, "Libra", "Alfa", "x")], "row_number int, marca string, nombre string, descripcion string")
    told = spark.createDataFrame([(2, "pass", []), (4, "reconstruct", ["too_short", "mojibake"])], "row_number int, status string, flags array<string>")
    got = flows.review(products, told).collect()
    assert [(r.nombre, r.status, r.flags) for r in got] == [("Alfa", "reconstruct", "too_short, mojibake"), ("beta", "sin_evaluar", ""), ("Zeta", "pass", "")]


def test_numbers_go_on_over_ranges(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "B", "b", "c/d", "É"]) + str(rng.randrange(60)), i) for i in range(900)] + [(None, 1), (None, 2)]
    got = align.rebased(spark.createDataFrame(rows, "path string, row int"), "path", "row").collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, (r[0] or "").lower(), r[0] or "", r[1]))
    assert [(r.path, r.row) for r in sorted(got, key=lambda r: r.row_number)] == order
    assert sorted(r.row_number for r in got) == list(range(2, 2 + len(rows)))


def test_long_reference_lists_give_the_same(spark):
    rng = random.Random(4)
    items = [(i, "".join(rng.choice("abc") for _ in range(rng.randint(1, 6)))) for i in range(150)] + [(999, "")]
    refs = [("".join(rng.choice("abc") for _ in range(rng.randint(1, 7))), rng.choice("XYZ")) for _ in range(60)] + [("", "X"), (None, "Y")]
    a, b = spark.createDataFrame(items, "i int, name_key string"), spark.createDataFrame(refs, "ref_key string, category string")
    got = [sorted((r.i, r.category_score, r.category or "") for r in categories.by_reference(a, b, packed=n).select("i", "category_score", "category").collect()) for n in (1000, 5)]
    assert got[0] == got[1] and len(got[0]) == 150 and len({c for _, _, c in got[0]}) > 2
