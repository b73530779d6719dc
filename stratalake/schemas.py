"""Table schemas. Bronze is always read with one of these, so a field that no record carries is null
instead of an analysis error, and no inference pass runs over the raw files."""

from pyspark.sql import types as T

CORRUPT_COLUMN = "_corrupt_record"


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, t) for name, t in fields.items()])


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def table_schema(columns: str) -> T.StructType:
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Scalars are read as the text they have in the file: a number may come quoted or with a fraction, and a typed
# reader would make it null before the projection's cast sees it. Bronze Parquet written by versions with typed
# leaves must be staged anew.
_S = T.StringType()


def _texts(*names: str) -> T.StructType:
    return _struct(**dict.fromkeys(names, _S))


CREDIT = _struct(
    artist=_texts("id", "name", "sort-name", "disambiguation", "type", "country")
)
RELEASE = _texts("id", "title", "date", "country", "status", "track-count")
SONG_FIELDS = ("id", "title", "length", "video", "score", "first-release-date")


def bronze_schema(songs: bool = True, credits: bool = True, releases: bool = True) -> T.StructType:
    """Envelope schema. The JSON reader parses every field it is given a type for, so a job that needs
    only one of the three parts should ask for that part alone."""
    fields: dict[str, T.DataType] = dict.fromkeys(SONG_FIELDS, _S) if songs else {}
    if credits:
        fields["artist-credit"] = T.ArrayType(CREDIT)
    if releases:
        fields["releases"] = T.ArrayType(RELEASE)
    return _struct(
        artist_search=_S,
        extracted_at=_S,
        data=_struct(recordings=T.ArrayType(_struct(**fields))),
    )


def with_corrupt(schema: T.StructType) -> T.StructType:
    """The schema with the column that takes unreadable text."""
    return T.StructType([*schema.fields, T.StructField(CORRUPT_COLUMN, T.StringType())])


BRONZE = bronze_schema()
# What each silver table needs of an envelope. Catalyst prunes a generator's input only when a single leaf
# of it is used, so jobs hand the scan the narrow schema themselves.
BRONZE_FOR = {
    "artists": bronze_schema(songs=False, releases=False),
    "albums": bronze_schema(songs=False, credits=False),
    "songs": bronze_schema(credits=False, releases=False),
}
PAYLOAD = BRONZE["data"].dataType

SILVER = {
    "artists": table_schema(
        "artist_id string, artist_name string, artist_sort_name string, artist_disambiguation string, "
        "artist_search string, extracted_at timestamp, artist_url string"
    ),
    "albums": table_schema(
        "album_id string, album_name string, country string, status string, track_count int, "
        "artist_search string, extracted_at timestamp, release_date date, album_url string"
    ),
    "songs": table_schema(
        "recording_id string, title string, length_ms bigint, video boolean, score int, "
        "artist_search string, extracted_at timestamp, first_release_date date"
    ),
}

SILVER_KEYS = {"artists": "artist_id", "albums": "album_id", "songs": "recording_id"}

GOLD = {
    "artist_summary": table_schema(
        "artist_search string, artist_id string, artist_name string, artist_sort_name string, "
        "artist_disambiguation string, extracted_at timestamp, artist_url string, "
        "total_recordings bigint, avg_song_length_min double, earliest_song_release date, "
        "latest_song_release date, total_albums bigint, distinct_release_countries bigint, "
        "earliest_album_release date, latest_album_release date, created_at timestamp"
    ),
    "yearly_release_metrics": table_schema(
        "release_year int, country_code string, total_releases bigint, avg_tracks_per_album double, "
        "distinct_artists bigint, created_at timestamp"
    ),
}
