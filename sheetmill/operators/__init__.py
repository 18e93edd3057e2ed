"""sheetmill.operators."""
