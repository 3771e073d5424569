"""Column functions: text, ASCII fold, prompt, verdict predicates, file names, judge calls."""
