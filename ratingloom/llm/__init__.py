"""Operations for building training data from documents and web pages."""
