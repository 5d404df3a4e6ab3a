"""Reading and writing: tables, CSV tapes, manual inputs, monthly appends."""
