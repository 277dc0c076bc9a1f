"""Applying fitted transforms to a streaming ``DataFrame``.

The source workloads are batch only (no watermarks, windows or state).
Fitted encoders are plain column expressions plus small static lookup
tables, so the same transforms score a stream through stream-static joins;
nothing here keeps streaming state.
"""

from stackyard.streaming.scoring import apply_codes, score_stream  # noqa: F401
