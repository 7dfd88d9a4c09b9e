"""lakeloom: a layered analytics warehouse written as DataFrame -> DataFrame functions."""
