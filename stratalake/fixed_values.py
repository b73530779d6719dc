"""Outputs are only right when these match character for character."""

ARTIST_URL_PREFIX = "https://musicbrainz.org/artist/"
RELEASE_URL_PREFIX = "https://musicbrainz.org/release/"

RECORDINGS_PER_SEARCH = 50

UNKNOWN_COUNTRY = "UNKNOWN"

DATE_FORMAT = "yyyy-MM-dd"
LANDING_STAMP_FORMAT = "yyyyMMdd_HHmmss"
EXPORT_STAMP_FORMAT = "yyyy-MM-dd-HH-mm-ss"

PENDING_FOLDER = "to_processed"
DONE_FOLDER = "processed"
