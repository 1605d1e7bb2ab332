"""All registered queries."""

from checks import files, linking, searching, webpages, wikitext  # noqa: F401
from checks.registry import QUERIES, SQL  # noqa: F401
