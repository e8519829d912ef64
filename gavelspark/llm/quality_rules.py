"""The induced rule list, as printed by train_quality with the sf0.1 tables (held-out accuracy 0.9894)."""

RULES = [
    [("prose_18", "<=", 0.5102), ("visible", ">", 125.5)],
    [("prose_22", "<=", 0.5798), ("punctuated_lines", "<=", 0.0742), ("common_words", "<=", 0.1744)],
    [("digit_lines", ">", 0.4437), ("punctuated_lines", "<=", 0.4808)],
    [("prose_22", "<=", 0.5052), ("punctuated_lines", "<=", 0.2236), ("mean_word_length", ">", 5.7997)],
    [("prose_18", "<=", 0.6543), ("symbol_lines", ">", 0.4348)],
    [("single_letters", ">", 0.3101)],
    [("symbol_ratio", ">", 0.0852), ("common_words", "<=", 0.3177), ("mean_word_length", "<=", 5.0939)],
]
