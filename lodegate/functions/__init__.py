"""Column functions: identity, text, dates, markup, pricing and retry rules."""
