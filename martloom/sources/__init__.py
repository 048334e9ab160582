"""File readers and writers of the layers."""
