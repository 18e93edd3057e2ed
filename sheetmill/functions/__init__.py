"""sheetmill.functions."""
