"""The registered queries, by theme. Importing this package registers them."""

from . import checks, evaluation, filters, matching, notices, pages, profiles, search, selection, state, streams, text, urls, written  # noqa: F401
