"""Reading documents, job descriptions and labels; writing rankings and labels."""
