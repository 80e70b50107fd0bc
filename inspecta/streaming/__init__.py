from inspecta.streaming.streams import budget_overruns, decode_budget, start_upsert, stream_feed  # noqa: F401
