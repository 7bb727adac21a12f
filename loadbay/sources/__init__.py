"""Reading raw and prepared logs, writing prepared, anonymised and exported tables."""
