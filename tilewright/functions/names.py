"""Scene names, links, storage paths and ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# mission+sensor token -> (platform, sensor) short names.
SENSORS = {
    "LC09": ("LANDSAT-9", "OLI"),
    "LO09": ("LANDSAT-9", "OLI"),
    "LC08": ("LANDSAT-8", "OLI"),
    "LO08": ("LANDSAT-8", "OLI"),
    "LE07": ("LANDSAT-7", "ETM+"),
    "LT05": ("LANDSAT-5", "TM"),
    "LT04": ("LANDSAT-4", "TM"),
    "S1A": ("SENTINEL-1", "Sentinel-1A"),
    "S1B": ("SENTINEL-1", "Sentinel-1B"),
    "S2A": ("SENTINEL-2", "Sentinel-2A"),
    "S2B": ("SENTINEL-2", "Sentinel-2B"),
}

# Asset key, file suffix, media type, role.
ASSETS = (
    ("data", ".nc", "application/netcdf", "data"),
    ("overview", ".png", "image/png", "overview"),
    ("thumbnail", "_thumb.png", "image/png", "thumbnail"),
)


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def first_token(text: Column) -> Column:
    return F.substring_index(text, "_", 1)


def sensor_token(name: Column, image: int) -> Column:
    """Mission+sensor token of image 1 or 2 of ``<scene>_X_<scene>_<rest>``; null if absent."""
    halves = F.split(base_name(name), "_X_")
    return first_token(F.try_element_at(halves, F.lit(image)))


def item_id(url: Column) -> Column:
    """File name without its ``.nc`` ending."""
    return F.regexp_replace(base_name(url), r"\.nc$", "")


def https_link(url: Column) -> Column:
    """Public link of an object; links that already are one pass through."""
    return F.regexp_replace(url, r"^s3://([^/]+)/(.*)$", r"https://$1.s3.amazonaws.com/$2")


def s3_link(url: Column) -> Column:
    """Object address of a public link; object addresses pass through."""
    return F.regexp_replace(url, r"^https://([^/]+?)\.s3\.amazonaws\.com/", r"s3://$1/")


def with_suffix(url: Column, suffix: str) -> Column:
    return F.concat(F.regexp_replace(url, r"\.nc$", ""), F.lit(suffix))


def asset_map(url: Column) -> Column:
    """The three assets of an item as ``map<key, struct<href,type,roles,alternate>>``."""
    none = F.lit(None).cast("map<string,struct<href:string,name:string>>")
    entries = []
    for key, suffix, media_type, role in ASSETS:
        target = with_suffix(url, suffix)
        alternate = (
            F.create_map(
                F.lit("s3"),
                F.struct(s3_link(target).alias("href"), F.lit("S3").alias("name")),
            )
            if key == "data"
            else none
        )
        asset = F.struct(
            https_link(target).alias("href"),
            F.lit(media_type).alias("type"),
            F.array(F.lit(role)).alias("roles"),
            alternate.alias("alternate"),
        )
        entries.append(F.struct(F.lit(key).alias("key"), asset.alias("value")))
    return F.map_from_entries(F.array(*entries))


def path_row(path: Column, row: Column) -> Column:
    """``path/row`` text; scenes without a path (missing or 0) give ``N/A``."""
    path, row = F.coalesce(path, F.lit(0)), F.coalesce(row, F.lit(0))
    text = F.concat_ws("/", path.cast("string"), row.cast("string"))
    return F.when(path != 0, text).otherwise(F.lit("N/A"))


def catalog_base(url: Column) -> Column:
    """``scheme://host/first/`` of a catalog path."""
    scheme = F.regexp_extract(url, r"^([A-Za-z0-9+.-]+)://", 1)
    host = F.regexp_extract(url, r"^[A-Za-z0-9+.-]+://([^/?#]*)", 1)
    return F.concat(scheme, F.lit("://"), host, F.lit("/"), _first_step(url), F.lit("/"))


def catalog_relative(url: Column) -> Column:
    """What follows the first step of a catalog path, with one trailing slash; may be empty."""
    rest = F.regexp_extract(_clean_path(url), r"^[^/]*/(.*)$", 1)
    return F.when(rest == "", F.lit("")).otherwise(F.concat(rest, F.lit("/")))


def _clean_path(url: Column) -> Column:
    path = F.regexp_extract(url, r"^[A-Za-z0-9+.-]+://[^/?#]*([^?#]*)", 1)
    return F.trim(path, F.lit("/"))


def _first_step(url: Column) -> Column:
    return F.substring_index(_clean_path(url), "/", 1)


def percent_decoded(text: Column) -> Column:
    """Percent-decode, leaving ``+`` and undecodable text as they are."""
    return F.coalesce(F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B"))), text)


def storage_bucket(path: Column) -> Column:
    return percent_decoded(F.substring_index(F.regexp_replace(path, "^s3://", ""), "/", 1))


def storage_prefix(path: Column) -> Column:
    """Decoded key prefix ending in ``/``; empty for a bare bucket."""
    rest = percent_decoded(F.regexp_extract(path, r"^s3://[^/]*/(.*)$", 1))
    return F.when((rest == "") | rest.endswith("/"), rest).otherwise(F.concat(rest, F.lit("/")))


def object_uri(bucket: str, prefix: Column, path: Column) -> Column:
    """Full address of a listed file."""
    return F.concat(F.lit(f"s3://{bucket}/"), F.rtrim(prefix, F.lit("/")), F.lit("/"), path)


def sidecar_path(data_href: Column, item: Column, suffix: str) -> Column:
    """Path of a sidecar beside the data file."""
    return F.concat(F.regexp_replace(data_href, r"/[^/]*$", "/"), item, F.lit(suffix))


def first_directory(key: Column, prefix: str) -> Column:
    """First directory level of a key below ``prefix``; empty when there is none."""
    quoted = "".join("\\" + c if not c.isalnum() and c not in "/_" else c for c in prefix)
    return F.regexp_extract(key, f"^({quoted}[^/]+/)", 1)


def line_md5(text: Column) -> Column:
    """MD5 of the text as one line, the id scripts give to files and jobs."""
    return F.md5(F.concat(text, F.lit("\n")))


def chunk_id(year: Column, number: Column) -> Column:
    return F.format_string("%s-chunk%04d", year, number.cast("int"))


def chunk_year(name: Column) -> Column:
    """Year part of a chunk file name, null when the name is not a chunk."""
    return _chunk_part(name, 1)


def chunk_number(name: Column) -> Column:
    return _chunk_part(name, 2).cast("int")


def _chunk_part(name: Column, group: int) -> Column:
    text = F.regexp_extract(base_name(name), r"^(.*?)-chunk([0-9]{1,9})(?:\..*)?$", group)
    return F.when(text == "", F.lit(None)).otherwise(text)


def glob_to_regex(pattern: str) -> str:
    """Regular expression of a file name glob with ``*``, ``?`` and ``[...]``."""
    out, i = [], 0
    while i < len(pattern):
        c = pattern[i]
        close = pattern.find("]", i + 2) if c == "[" else -1
        if c == "*":
            out.append(".*")
        elif c == "?":
            out.append(".")
        elif close > 0:
            body = pattern[i + 1 : close].replace("\\", "\\\\")
            out.append("[" + ("^" + body[1:] if body[0] == "!" else body) + "]")
            i = close
        else:
            out.append(c if c.isalnum() or c == "_" else "\\" + c)
        i += 1
    return "(?s)^" + "".join(out) + "$"


def json_href(assets_json: Column, asset: str = "data") -> Column:
    """Href inside an assets JSON text."""
    return F.get_json_object(assets_json, f"$.{asset}.href")
