"""The four canonical entities: fields, types, aliases; and their Spark schemas."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

ENTITIES = ("productos", "variantes", "precios", "clientes")


@dataclass(frozen=True)
class Field:
    name: str
    type: str = "text"
    required: bool = False
    aliases: tuple[str, ...] = ()


# Field names, types and aliases of the import contract. Text fields unless marked; * is required.
_TABLE = {
    "productos": """
        sku = codigo, código, cod, clave
        nombre* = producto, nombres, nombre producto, nombre del producto
        descripcion = descripción, detalle
        descripcion_corta = descripcion corta, resumen
        categoria = categoría, categoria nombre
        marca = marca nombre
        tipo = tipo producto
        destacado:boolean
        es_digital:boolean = digital
        tags = etiquetas, tag
        atributos:attributes = ficha, especificaciones
        precio:number
        precio_comparacion = precio comparacion, precio anterior, precio tachado
        costo:number = costo unitario, precio costo
        activo:boolean = publicado, visible, habilitado
        peso:number = peso kg
        stock:number = existencias, cantidad, inventario
        stock_minimo:number = stock minimo, minimo, punto de reposicion""",
    "variantes": """
        sku_producto* = sku padre, producto, sku producto
        sku_variante = sku, codigo variante, cod variante
        atributos:attributes* = atributo, opciones, variacion
        precio:number
        precio_comparacion = precio comparacion, precio anterior, precio tachado
        stock:number = existencias, cantidad, inventario
        activa:boolean = activo, habilitada, disponible""",
    "precios": """
        sku* = codigo, código, sku producto
        sku_variante = variante, sku variante
        lista = lista de precios, lista precios
        precio:number*
        precio_comparacion = precio comparacion, precio anterior, precio tachado""",
    "clientes": """
        nombre* = nombres, cliente
        apellido = apellidos
        razon_social = razon social, empresa
        tipo = tipo cliente
        email = correo, e-mail, mail
        celular = telefono, whatsapp, wsp, phone, tel
        nit_ci = nit, ci, documento, carnet
        profesion = profesión
        titulo = título
        fecha_nacimiento:date = nacimiento, cumpleanos, fecha nacimiento
        direccion = direccion completa, domicilio
        ciudad = localidad
        lista_precios = lista, audiencia, tarifa
        notas = nota, observaciones, comentarios
        activo:boolean = habilitado
        origen""",
}


def _read(line: str) -> Field:
    head, _, aliases = line.partition("=")
    head = head.strip()
    required = head.endswith("*")
    name, _, kind = head.rstrip("*").partition(":")
    return Field(name, kind or "text", required, tuple(a.strip() for a in aliases.split(",") if a.strip()))


FIELDS = {entity: tuple(_read(x) for x in lines.strip().splitlines()) for entity, lines in _TABLE.items()}
SPARK_TYPES = {"text": T.StringType(), "number": T.DecimalType(38, 10), "boolean": T.BooleanType(), "date": T.DateType(), "attributes": T.MapType(T.StringType(), T.StringType())}


def fields_for(entity: str) -> tuple[Field, ...]:
    if entity not in FIELDS:
        raise ValueError(f"unknown entity {entity!r}; one of {', '.join(ENTITIES)}")
    return FIELDS[entity]


def data_schema(entity: str) -> T.StructType:
    """The declared schema of an entity's records; sinks always write it in full, so files keep one schema."""
    return T.StructType([T.StructField(f.name, SPARK_TYPES[f.type], True, {"required": f.required, "type": f.type}) for f in fields_for(entity)])
