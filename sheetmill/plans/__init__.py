"""sheetmill.plans."""
