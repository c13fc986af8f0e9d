"""Column functions: date keys, business codes and classifications, text helpers."""
