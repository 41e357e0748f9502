"""Column builders: cleaning, rendering, tokens and run metadata."""
