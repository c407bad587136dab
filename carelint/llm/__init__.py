"""Training-data operators: ten independent modules and their registered queries."""
