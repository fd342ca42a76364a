"""casegrain.operators"""
