"""Column helpers and distributed order statistics shared by the operators."""
