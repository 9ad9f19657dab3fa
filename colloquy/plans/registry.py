"""All registered queries of the dialogue library and their SQL."""

from __future__ import annotations

from colloquy.plans import audio, clips, feeds, losses, samples, texts
from colloquy.sources.views import with_views

PARTS = (texts, clips, audio, samples, losses, feeds)
QUERIES = {k: f for part in PARTS for k, f in part.QUERIES.items()}
SQL = {k: with_views(s) for part in PARTS for k, s in part.SQL.items()}
