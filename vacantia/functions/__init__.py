"""vacantia.functions"""
