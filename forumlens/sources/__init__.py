"""Readers and writers: raw JSON, warehouse tables, seen-id ledger, configuration, pages."""
