"""Set-based operators: decoding, quarantine, points, routing, payloads, reports."""
