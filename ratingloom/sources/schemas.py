"""Fixed table layouts. Nothing is inferred: postal codes stay text, coordinates double."""

from __future__ import annotations

from pyspark.sql import types as T


def struct(spec: str) -> T.StructType:
    kinds = {"s": T.StringType(), "d": T.DoubleType(), "i": T.IntegerType(), "l": T.LongType()}
    fields = (item.split(":") for item in spec.split())
    return T.StructType([T.StructField(name, kinds[kind], True) for name, kind in fields])


# Positions of the used fields in the incoming tab-separated lines.
BUSINESS_MIN_FIELDS = 14
BUSINESS_POSITIONS = {
    "business_id": 0, "name": 1, "address": 2, "city": 3, "state": 4, "postal": 5,
    "lat": 6, "lon": 7, "review_count": 9, "categories": 12, "opening_hours": 13,
}
REVIEW_FIELDS = 9
REVIEW_POSITIONS = {"review_id": 0, "business_id": 2, "stars": 3, "review_text": 7, "datetime": 8}

BUSINESS = struct(
    "business_id:s name:s address:s city:s state:s postal:s lat:d lon:d "
    "review_count:i categories:s opening_hours:s"
)
REVIEW = struct("review_id:s business_id:s stars:d review_text:s datetime:s")
PLACE = "business_id name address city state postal lat lon categories opening_hours".split()
RAW = struct(
    "business_id:s name:s address:s city:s state:s postal:s lat:d lon:d "
    "categories:s opening_hours:s stars:d review_text:s datetime:s"
)
STARS = [f"star{i}" for i in range(6)]
AGGREGATED = struct(
    "business_id:s name:s address:s city:s state:s postal:s lat:d lon:d "
    "categories:s opening_hours:s " + " ".join(f"{c}:i" for c in STARS) + " total:i"
)
KPIS = struct("metric:s value:s")
WORD_COUNTS = struct("word:s count:l")

# A GeoJSON feature. The nesting of `coordinates` depends on `type`, so it is read as text first.
FEATURE = T.StructType([
    T.StructField("properties", T.StructType([T.StructField("NAME", T.StringType())])),
    T.StructField("geometry", T.StructType([
        T.StructField("type", T.StringType()),
        T.StructField("coordinates", T.StringType()),
    ])),
])
