"""Raw records of the surfaces of a publisher as observations of one schema, each with an identity that does not move."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliomill.functions.text import collapse

SECURE = "https://"


def bulletin_url(raw: Column) -> Column:
    """(url, state): nulls, nulls in words and a null written before the address are known defects; other shapes are not."""
    value = F.trim(raw)
    defect = F.concat(F.lit("NULL"), F.lit(SECURE))
    state = (
        F.when(raw.isNull(), "source_null")
        .when((value == "") | (F.lower(value) == "null"), "source_null_text")
        .when(value.startswith(SECURE), "available")
        .when(F.startswith(value, defect), "stripped")
        .otherwise("unsupported")
    )
    url = F.when(value.startswith(SECURE), value).when(F.startswith(value, defect), F.substring(value, 5, 1 << 30))
    return F.struct(url.alias("url"), state.alias("state"))


def observations(df: DataFrame, surface: str = "surface", row: str = "row") -> DataFrame:
    """(surface, identity, row_key, url, availability, error) for rows whose ``row`` is the JSON of one record.

    A decision is named by its file and blob, a bulletin by header and body, a historical record, which has no id, by the
    digest of its address. ``row_key`` holds the business key, which does not depend on an address. A record that lacks
    its id or an address of the right kind has an error and no identity.
    """
    get = lambda name: F.coalesce(F.trim(F.get_json_object(row, f"$.{name}")), F.lit(""))
    s = F.trim(surface)
    file, blob, parties = get("idExpediente"), get("guidBlob"), collapse(get("partes"))
    bulletin = bulletin_url(F.get_json_object(row, "$.urlCuerpo"))
    address = F.when(s == "decisions", get("urlBlob")).when(s == "historical", get("rutaDoc")).when(s == "bulletins", bulletin["url"])
    error = (
        F.when(~s.isin("decisions", "historical", "bulletins") | s.isNull(), "unknown_surface")
        .when((s == "decisions") & (file == ""), "no_id")
        .when((s == "historical") & (F.concat(get("ano"), get("mes"), parties) == ""), "no_metadata")
        .when((s == "bulletins") & (get("idCuerpo") == ""), "no_id")
        .when((s == "bulletins") & (bulletin["state"] == "unsupported"), "no_address")
        .when((s != "bulletins") & ~address.startswith(SECURE), "no_address")
    )
    identity = (
        F.when(s == "decisions", F.concat(F.lit("expediente:"), file, F.when(blob != "", F.concat(F.lit(":"), blob)).otherwise(F.lit(""))))
        .when(s == "historical", F.concat(F.lit("historical-url-sha256:"), F.sha2(address, 256)))
        .when(s == "bulletins", F.concat(F.lit("bulletin:"), get("idCabecera"), F.lit(":"), get("idCuerpo")))
    )
    key = F.when(s == "decisions", F.concat_ws("\t", s, file, blob)).when(s == "historical", F.concat_ws("\t", s, get("ano"), get("mes"), parties))
    available = F.when(error.isNull(), F.when(address.isNull(), "not_published").otherwise("available"))
    return df.select(
        s.alias("surface"), F.when(error.isNull(), identity).alias("identity"), key.alias("row_key"), F.when(error.isNull(), address).alias("url"),
        available.alias("availability"), error.alias("error"),
    )
