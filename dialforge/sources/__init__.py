"""Sources and sinks: the prompt catalogue and modifier lists, JSON Lines
records (strict / lenient scan, append sink, line count) and the Parquet
store (writes tuned for long text, shard union by name)."""
