import json
from concurrent.futures import ThreadPoolExecutor

import pytest

from saltmarsh import config, state
from saltmarsh.__main__ import main


def test_profiles_and_settings(tmp_path):
    path = tmp_path / "p.yml"
    path.write_text("entity: productos\ncolumns:\n  Código: sku\n  Nombre: nombre\ndefaults:\n  activo: true\n")
    p = config.mapping_profile(str(path))
    assert (p.entity, p.columns, p.defaults) == ("productos", {"Código": "sku", "Nombre": "nombre"}, {"activo": True})
    path.write_text("entity: nada\ncolumns: {}\n")
    with pytest.raises(ValueError):
        config.mapping_profile(str(path))
    env = tmp_path / ".env"
    env.write_text("# note\nA=1\nB='x y'\n")
    assert config.load_dotenv(str(env), {"A": "0"}) == {"A": "0", "B": "x y"}


def test_state_versions(spark, tmp_path):
    path = str(tmp_path / "state")
    df = spark.createDataFrame([("k", "LIB-0001")], "identity_key string, sku string")
    old, v = state.load(spark, path, df.schema)
    assert old.count() == 0 and v == 0
    assert state.save(df, path, v) == 1
    again, v = state.load(spark, path, df.schema)
    assert [tuple(r) for r in again.collect()] == [("k", "LIB-0001")] and v == 1
    with pytest.raises(RuntimeError):
        state.save(df, path, 0)
    assert state.versions(spark, path) == [1]
    grown = df.unionByName(spark.createDataFrame([("l", "LIB-0002")], df.schema))
    assert state.save(grown, path, 1) == 2 and state.load(spark, path, df.schema)[0].count() == 2


def test_one_of_two_writers_wins(spark, tmp_path):
    path = str(tmp_path / "state")
    df = spark.createDataFrame([("k", "LIB-0001")], "identity_key string, sku string")
    state.save(df, path, 0)

    def save(_):
        try:
            return state.save(df, path, 1)
        except RuntimeError:
            return None

    with ThreadPoolExecutor(4) as pool:
        done = list(pool.map(save, range(4)))
    assert sorted(d or 0 for d in done) == [0, 0, 0, 2] and state.load(spark, path, df.schema)[0].count() == 1


def test_command_line(spark, tmp_path, capsys):
    path = tmp_path / "in.csv"
    path.write_text("Código,Nombre,Precio\nPR-1,Crema,89\nPR-1,Otra,-1\n")
    assert main(["preview", str(path)]) == 0
    assert json.loads(capsys.readouterr().out)["mapping"] == {"Código": "sku", "Nombre": "nombre", "Precio": "precio"}
    assert main(["validate", str(path)]) == 2
    assert json.loads(capsys.readouterr().out)["report"]["invalid_rows"] == 1
    path.write_text("Código,Nombre,Precio\nPR-1,Crema,89\nPR-2,Otra,1\n")
    out = str(tmp_path / "out")
    assert main(["validate", str(path), "--out", out]) == 0
    run_id = json.loads(capsys.readouterr().out)["run_id"]
    assert main(["approve", "--out", out, "--run-id", run_id, "--by", "ana"]) == 0
    capsys.readouterr()
    assert main(["inspect", "--out", out, "--run-id", run_id]) == 0
    assert json.loads(capsys.readouterr().out)["status"] == "approved"


def test_variant_prices_command(spark, tmp_path, capsys):
    files = {"p": "sku,nombre,precio\nLIB-0001,Crema,\n", "v": 'sku_producto,sku_variante,atributos,precio\nLIB-0001,LIB-0001-V01,"{""presentacion"": ""50 g""}",\nLIB-0001,LIB-0001-V02,"{""presentacion"": ""1 kg""}",\n', "l": "sku,nombre,precio,costo\nLIB-0001,Crema 50 grs,Bs 30,10\nLIB-0001,Crema 1kg,Bs 200,\n"}
    for name, text in files.items():
        (tmp_path / f"{name}.csv").write_text(text)
    args = [f"--{n}={tmp_path}/{f}.csv" for n, f in (("products", "p"), ("variants", "v"), ("prices", "l"))]
    assert main(["enrich-variants", *args, f"--out={tmp_path}/out"]) == 0
    assert json.loads(capsys.readouterr().out)["unmatched"] == 0
    variants = spark.read.option("header", True).csv(f"{tmp_path}/out/variantes.csv")
    assert sorted((r.sku_variante, r.precio) for r in variants.collect()) == [("LIB-0001-V01", "30"), ("LIB-0001-V02", "200")]
    assert spark.read.option("header", True).csv(f"{tmp_path}/out/productos.csv").first().precio == "30"


def test_review_command(spark, tmp_path):
    (tmp_path / "p.csv").write_text("marca,nombre,descripcion\nRouse,Zeta,Texto legible.\nLibra,Alfa,Otra <b>\n")
    assert main(["review", f"{tmp_path}/p.csv", f"--out={tmp_path}/r.html"]) == 0
    page = (tmp_path / "r.html").read_text()
    assert page.index("Libra") < page.index("Rouse") and "Otra &lt;b&gt;" in page and "too_short" in page
