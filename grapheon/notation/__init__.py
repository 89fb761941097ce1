"""The textual notation: tokens, statements, declarations, and the relations they derive."""
