"""Streaming: process-once loading of extract files from an inbox."""

from .process_once import ledger_path, process_once

__all__ = ["ledger_path", "process_once"]
