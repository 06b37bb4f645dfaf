"""Catalogue schemas and per-media-type cleaning rules.

Movies and TV shows share every operator; what differs is captured by one
``MediaSpec`` value, so nothing is written twice per media type or per decade.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

# Fixed values that must equal the reference's for identical results:
# the fill text for a missing overview, the fill date, the fill ratings,
# the fill language, the page cap of the change listing, and the look-back
# days of the change collection (movies 3, TV 10).
OVERVIEW_FILL = "Sem informação."
DATE_FILL = "1900-01-01"
MOVIE_RATING_FILL = "0.0"
TV_RATING_FILL = 0.0
LANGUAGE_FILL = "en"
CHANGE_PAGE_CAP = 500
MOVIE_LOOKBACK_DAYS = 3
TV_LOOKBACK_DAYS = 10

# The field names, types and order of the two catalogue schemas,
# and the column order of silver TV shows, as the reference's datasets have them.
MOVIE_SCHEMA = StructType([
    StructField("id", IntegerType(), True),
    StructField("title", StringType(), True),
    StructField("overview", StringType(), True),
    StructField("release_date", StringType(), True),
    StructField("vote_average", StringType(), True),
    StructField("genre_ids", ArrayType(IntegerType()), True),
])

TV_SCHEMA = StructType([
    StructField("genre_ids", ArrayType(IntegerType()), True),
    StructField("id", IntegerType(), True),
    StructField("origin_country", ArrayType(StringType()), True),
    StructField("original_language", StringType(), True),
    StructField("original_name", StringType(), True),
    StructField("overview", StringType(), True),
    StructField("first_air_date", StringType(), True),
    StructField("name", StringType(), True),
    StructField("vote_average", DoubleType(), True),
])

# Silver TV keeps the column order the clean step produces: both name columns
# are rebuilt and therefore move to the end (fixed value, see above).
TV_SILVER_ORDER = [
    "genre_ids", "id", "origin_country", "original_language", "overview",
    "first_air_date", "vote_average", "name", "original_name",
]

GENRE_STRUCT = StructType([
    StructField("id", IntegerType(), True),
    StructField("name", StringType(), True),
])

# Landed detail bodies: the record plus ``genres`` objects instead of ids.
MOVIE_DETAIL_SCHEMA = StructType(
    [f for f in MOVIE_SCHEMA.fields if f.name != "genre_ids"]
    + [StructField("genres", ArrayType(GENRE_STRUCT), True)]
)
TV_DETAIL_SCHEMA = StructType(
    [f for f in TV_SCHEMA.fields if f.name != "genre_ids"]
    + [StructField("genres", ArrayType(GENRE_STRUCT), True)]
)

CHANGE_ITEM = StructType([StructField("id", IntegerType(), True)])


def page_schema(record: StructType) -> StructType:
    """Envelope of one page of a paged listing."""
    return StructType([
        StructField("page", IntegerType(), True),
        StructField("total_pages", IntegerType(), True),
        StructField("total_results", IntegerType(), True),
        StructField("results", ArrayType(record), True),
    ])


@dataclass(frozen=True)
class MediaSpec:
    """Everything that differs between the two media types."""

    name: str
    schema: StructType
    bronze_prefix: str            # slice directories are ``<prefix><suffix>``
    changes_dataset: str
    fills: dict
    arrays: dict                  # column -> element type of a typed empty array
    required: tuple               # columns that must be non-null (movies)
    name_pair: tuple | None       # mutually coalesced columns (TV)
    silver_order: list = field(default_factory=list)
    detail_schema: StructType | None = None
    # Array fields whose *missing* key means an empty array (an explicit JSON
    # null stays null), in listing records and in detail bodies.
    record_missing_empty: tuple = ()
    detail_missing_empty: tuple = ()
    lookback_days: int = MOVIE_LOOKBACK_DAYS
    # Detail fields whose *missing* key takes a default (an explicit JSON null
    # stays null).
    detail_missing_default: dict = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]


MOVIE = MediaSpec(
    name="movie",
    schema=MOVIE_SCHEMA,
    bronze_prefix="movie_",
    changes_dataset="movies_changes",
    fills={"overview": OVERVIEW_FILL, "release_date": DATE_FILL,
           "vote_average": MOVIE_RATING_FILL},
    arrays={"genre_ids": IntegerType()},
    required=("id", "title"),
    name_pair=None,
    silver_order=[f.name for f in MOVIE_SCHEMA.fields],
    detail_schema=MOVIE_DETAIL_SCHEMA,
    detail_missing_default={"vote_average": MOVIE_RATING_FILL},
)

TV = MediaSpec(
    name="tv",
    schema=TV_SCHEMA,
    bronze_prefix="tv_shows_",
    changes_dataset="tv_changes",
    fills={"overview": OVERVIEW_FILL, "first_air_date": DATE_FILL,
           "vote_average": TV_RATING_FILL, "original_language": LANGUAGE_FILL},
    arrays={"origin_country": StringType(), "genre_ids": IntegerType()},
    required=("id",),
    name_pair=("name", "original_name"),
    silver_order=TV_SILVER_ORDER,
    detail_schema=TV_DETAIL_SCHEMA,
    record_missing_empty=("genre_ids", "origin_country"),
    detail_missing_empty=("origin_country",),
    lookback_days=TV_LOOKBACK_DAYS,
    detail_missing_default={"vote_average": TV_RATING_FILL},
)

SPECS = {"movie": MOVIE, "tv": TV}
