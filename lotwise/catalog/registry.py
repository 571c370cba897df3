"""All registered queries by operator name."""

from __future__ import annotations

from lotwise.catalog import features, inputs, results, streams
from lotwise.catalog.entry import Entry

ENTRIES: dict[str, Entry] = {**inputs.ENTRIES, **features.ENTRIES, **results.ENTRIES, **streams.ENTRIES}
