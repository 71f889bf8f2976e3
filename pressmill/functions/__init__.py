"""Column builders: text, dates, rules, replies, vectors."""
