"""Explicit schemas of everything read or written."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


STRING, LONG, INT = T.StringType(), T.LongType(), T.IntegerType()
DOUBLE, BOOLEAN, DATE, TIMESTAMP = T.DoubleType(), T.BooleanType(), T.DateType(), T.TimestampType()

POINT = _struct(lon=DOUBLE, lat=DOUBLE)
RING = T.ArrayType(POINT)
BBOX = _struct(xmin=DOUBLE, ymin=DOUBLE, xmax=DOUBLE, ymax=DOUBLE)
CHAINS = T.ArrayType(_struct(area=BOOLEAN, points=RING))
FOOTPRINT = _struct(ring=RING, bbox=BBOX, center=POINT)

GRANULE = _struct(
    url=STRING, id_img1=STRING, id_img2=STRING, acquisition_date_img1=STRING,
    acquisition_date_img2=STRING, date_center=STRING, date_dt=DOUBLE, roi_valid_percentage=DOUBLE,
    flight_direction_img1=STRING, path_img1=INT, row_img1=INT, path_img2=INT, row_img2=INT,
    date_created=STRING, date_updated=STRING, x_first=DOUBLE, x_last=DOUBLE, y_first=DOUBLE,
    y_last=DOUBLE, geotransform=STRING, spatial_epsg=INT,
)

FILE_LIST = _struct(prefix=STRING, path=STRING)
LISTING = _struct(region=STRING, key=STRING)

ALTERNATE = T.MapType(STRING, _struct(href=STRING, name=STRING))
ASSET = _struct(href=STRING, type=STRING, roles=T.ArrayType(STRING), alternate=ALTERNATE)

# Written property keys of an item, in order.
PROPERTY_TYPES = {
    "mid_datetime": STRING,
    "created": STRING,
    "updated": STRING,
    "latitude": DOUBLE,
    "longitude": DOUBLE,
    "date_dt": DOUBLE,
    "platform": STRING,
    "scene_1_id": STRING,
    "scene_2_id": STRING,
    "scene_1_path_row": STRING,
    "scene_2_path_row": STRING,
    "sat:orbit_state": STRING,
    "start_datetime": STRING,
    "end_datetime": STRING,
    "percent_valid_pixels": INT,
    "proj:code": STRING,
    "version": STRING,
}

# One catalog row: properties flattened beside the geometry.
ITEM_ROW = T.StructType(
    [
        T.StructField("id", STRING),
        T.StructField("collection", STRING),
        T.StructField("ring", RING),
        T.StructField("bbox", BBOX),
        T.StructField("datetime", TIMESTAMP),
        *[T.StructField(n, t) for n, t in PROPERTY_TYPES.items()],
        T.StructField("assets", T.MapType(STRING, ASSET)),
    ]
)

# One line of item NDJSON.
ALTERNATE_JSON = T.MapType(
    STRING,
    T.StructType([T.StructField("href", STRING), T.StructField("alternate:name", STRING)]),
)
ITEM_JSON = T.StructType(
    [
        T.StructField("type", STRING),
        T.StructField("stac_version", STRING),
        T.StructField("stac_extensions", T.ArrayType(STRING)),
        T.StructField("id", STRING),
        T.StructField("collection", STRING),
        T.StructField(
            "geometry",
            _struct(type=STRING, coordinates=T.ArrayType(T.ArrayType(T.ArrayType(DOUBLE)))),
        ),
        T.StructField("bbox", T.ArrayType(DOUBLE)),
        T.StructField(
            "properties",
            T.StructType(
                [
                    T.StructField("datetime", STRING),
                    *[T.StructField(n, t) for n, t in PROPERTY_TYPES.items()],
                ]
            ),
        ),
        T.StructField("links", T.ArrayType(STRING)),
        T.StructField(
            "assets",
            T.MapType(
                STRING,
                _struct(
                    href=STRING, type=STRING, roles=T.ArrayType(STRING), alternate=ALTERNATE_JSON
                ),
            ),
        ),
    ]
)

PROGRESS = _struct(
    status=STRING, file=STRING, start_ts=STRING, end_ts=STRING, items=LONG, secs=LONG, note=STRING
)
COUNT_CACHE = _struct(dir=STRING, count=LONG, as_of=DATE)
REGION_STATE = _struct(region=STRING, last_batch=LONG, total_files_processed=LONG)
CHUNK_MANIFEST = _struct(
    region=STRING, year=STRING, chunk=INT, id=STRING, timestamp=STRING, size_bytes=LONG,
    md5_hash=STRING, item_count=LONG,
)
