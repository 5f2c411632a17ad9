"""Where points go: line-protocol text, payloads, typed and upserted tables, child tables."""
