"""reelyard: media-catalogue pipelines (bronze -> silver -> upserts) on Spark."""

from reelyard.schemas import MOVIE, TV, MediaSpec  # noqa: F401
