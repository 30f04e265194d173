"""The analyses, each a short chain of operators."""
