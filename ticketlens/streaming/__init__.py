"""Structured Streaming: message log, subscriber state and opt-in webhooks."""
