"""Row and key operators."""
