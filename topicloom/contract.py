"""The dataset contract: which columns a source must offer and how its dates are written."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field


@dataclass(frozen=True)
class DataContract:
    """Required canonical columns, renames from raw names, and the reading of the date column.

    ``date_unit`` is one of ``s``, ``ms``, ``us``, ``ns`` for numeric dates; ``date_format`` is a strftime
    pattern for text dates; with neither, ISO text is expected.
    """

    required_columns: tuple[str, ...]
    column_mapping: Mapping[str, str] = field(default_factory=dict)
    date_column: str = "date"
    date_format: str | None = None
    date_unit: str | None = None
    max_null_count: int = 0
    max_invalid_date_count: int = 0


# The canonical columns of a post and the raw names they come from.
POST_CONTRACT = DataContract(
    required_columns=(
        "post_id",
        "date",
        "subreddit",
        "title",
        "body",
        "url",
        "author",
        "score",
        "num_comments",
        "is_self",
        "permalink",
    ),
    column_mapping={"id": "post_id", "created_utc": "date", "selftext": "body"},
    date_unit="s",
)
VALUE_CONTRACT = DataContract(
    required_columns=("date", "value"),
    column_mapping={"Date": "date", "Amount": "value"},
)
